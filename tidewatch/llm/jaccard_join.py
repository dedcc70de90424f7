"""N-gram Jaccard join by PartEnum signatures.

Two sets of n and m shingles with a similarity of num/den or more differ in at most (den - num)(n + m) / (den + num) shingles. Sets are
put into bands of sizes; a band fixes how the domain of shingles is partitioned: into groups, each of them into `cells`. A signature is
what a set holds in `taken` of the cells of one group, and all such subsets of cells are enumerated. The differing shingles cannot spoil
all of them, so sufficiently similar sets of a band share a signature. A set that may be similar to larger ones of the next band
makes that band's signatures too; buckets without a set of the band itself make no pairs.

Not all signatures are needed. Similar sets share at least `Scheme.shared` of them; of these the last in any order fixed by the
signatures alone stands, in both sets, among the first `all - shared + 1`. The order is by the shingles that a signature holds, most
first, so that empty or light ones, which unrelated texts share, are not made.

Equal sets form a class first. In a bucket, members are verified on their full sets against two heads, and links merge components. In
buckets that then still hold several components, members outside the largest one meet the others, behind two exact bounds: the sizes, and
the differing bits of two maps of parities (a differing shingle turns one bit, so the bits never count more than the shingles). No link
is lost, no group is paired with itself.

Defined cases: null or empty text has no shingles and is linked with nothing; fewer words than a shingle are one shingle; rows with equal
text are in one component; repeated ids are judged each row by its text; a null doc_id is never the smallest of a component unless no row
of it has an id, and then component_id is null; very long texts are joined whole; an empty table gives an empty result; other columns are
not read; ids keep their type.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialise
from .near_dedup import _mix, components, digest, full_sets, head_pairs, labelled, merged_by, shingle_sets, verified

SHINGLE, NUM, DEN = 4, 85, 100
#: Upper size of the first band; each further band ends at twice the size.
FIRST_BAND = 5
#: Bits of the map of parities.
BITS = 512
_WORDS = BITS // 64
#: Sets that differ in so few shingles take two of three cells; in larger ones single cells of pairs hold enough.
FEW = 7


def differing(n: int, m: int, num: int = NUM, den: int = DEN) -> int:
    """Shingles that two similar sets of n and m can differ in."""
    return (den - num) * (n + m) // (den + num)


class Scheme(NamedTuple):
    """Partitions of a band: groups of `cells` cells; a signature holds `taken` cells of a group."""

    band: int
    groups: int
    cells: int
    taken: int

    @property
    def signatures(self) -> int:
        return self.groups * comb(self.cells, self.taken)

    def shared(self, differ: int) -> int:
        """Signatures that two sets share at least if they differ in so many shingles: each shingle spoils a cell, first where it spoils most."""
        left = [comb(self.cells - k, self.taken) for k in range(self.cells + 1)]
        lost, at = 0, 0
        while differ > 0 and at < self.cells:
            here = min(differ, self.groups)
            lost += here * (left[at] - left[at + 1])
            differ -= here
            at += 1
        return self.signatures - lost


@cache
def scheme(band: int, num: int = NUM, den: int = DEN) -> Scheme:
    top = FIRST_BAND * 2**band
    most = differing(top, top, num, den)
    if most <= FEW:
        return Scheme(band, most // 2 + 1, 3, 2)
    return Scheme(band, (most + 1 + 2 + most // 16 + 1) // 2, 2, 1)


def band_of(size: int) -> int:
    return max(0, (-(-size // FIRST_BAND) - 1).bit_length())


def largest(size: int, num: int = NUM, den: int = DEN) -> int:
    """Size of the largest set that can be similar to one of `size`."""
    return size * den // num


@cache
def _cuts(cells: int) -> np.ndarray:
    return np.array([k * 2**64 // cells for k in range(1, cells)], np.uint64)


@cache
def _subsets(s: Scheme) -> np.ndarray:
    """Cells of each signature, group by group."""
    one = np.array(list(combinations(range(s.cells), s.taken)), np.int64)
    return (np.arange(s.groups)[:, None, None] * s.cells + one).reshape(-1, s.taken)


def enumerated(shingles: np.ndarray, mixed: np.ndarray, s: Scheme, differ: int) -> np.ndarray:
    """The signatures that a set needs so as to share one with each set that differs in at most `differ` shingles. shingles: sorted hashes, spread evenly; mixed: another hash of each."""
    cells = s.groups * s.cells
    ends = np.concatenate([[0], np.searchsorted(shingles, _cuts(cells)), [len(shingles)]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])[ends]
    held = np.diff(ends)
    value = _mix(np.diff(sums) + held.astype(np.uint64) + np.arange(cells, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    spots = _subsets(s)
    key = _mix(value[spots].sum(axis=1, dtype=np.uint64) + np.arange(len(spots), dtype=np.uint64) + np.uint64(s.band * 0xD1B54A32D192ED03 % 2**64))
    need = s.signatures - s.shared(differ) + 1
    return key[np.lexsort((key, -held[spots].sum(axis=1)))[:need]]


def signatures_of(shingles: np.ndarray, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, int]:
    """A set's signatures, and how many of them are of its own band (the others are the next band's)."""
    size = len(shingles)
    band, most = band_of(size), largest(size, num, den)
    top = FIRST_BAND * 2**band
    mixed = _mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    own = above = shingles[:0]
    if (differ := differing(size, min(most, top), num, den)) > 0:
        own = enumerated(shingles, mixed, scheme(band, num, den), differ)
    if most > top:
        above = enumerated(shingles, mixed, scheme(band + 1, num, den), differing(size, most, num, den))
    return np.concatenate([own, above]), len(own)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each of BITS bits, as 64-bit words."""
    spot = _mix(shingles + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)
    return np.packbits((np.bincount(spot.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


_MARKS = [f"s{i}" for i in range(_WORDS)]
SIGNED = f"row long, doc_id string, n_shingles long, set_id binary, keys array<long>, n_own int, {', '.join(f'{x} long' for x in _MARKS)}"


def signed(docs: DataFrame, doc_id: str, text: str, num: int, den: int) -> DataFrame:
    """(row, doc_id, n_shingles, set_id, keys, n_own, s0..s7) of each row; without shingles set_id and keys are null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in blocks([x or "" for x in batch["text"]], 1_000_000):
                rows = []
                for s in shingle_sets(list(batch["text"][a:b]), SHINGLE):
                    if not len(s):
                        rows.append((0, None, None, 0, *[0] * _WORDS))
                        continue
                    keys, own = signatures_of(s, num, den)
                    rows.append((len(s), digest(s), keys.view(np.int64), own, *parities(s).tolist()))
                out = pd.DataFrame(rows, columns=["n_shingles", "set_id", "keys", "n_own", *_MARKS])
                out.insert(0, "row", batch["row"][a:b].to_numpy())
                out.insert(1, "doc_id", batch["doc_id"][a:b].to_numpy())
                yield out

    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInPandas(run, SIGNED).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _near(a: str, b: str, num: int, den: int) -> Column:
    """Whether the sizes and parities of two sets leave it open that they are similar."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    bits = reduce(Column.__add__, (F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in _MARKS))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & ((den + num) * bits <= (den - num) * (n + m))


def _across(members: DataFrame, comp: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components that share a signature and pass the exact bounds. Members of a bucket's largest component meet those of other components only."""
    now = members.where("n > 3").select("key", "node").join(comp, "node")
    counts = now.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("comps")).where("comps > 1").select("key", "main")
    told = materialise(now.join(main, "key").join(known, "node"), "told")
    once = (F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    met = told.where("comp <> main").alias("x").join(told.alias("y"), "key").where((F.col("x.comp") != F.col("y.comp")) & once & _near("x", "y", num, den))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs."""
    rows = materialise(signed(docs, doc_id, text, num, den), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), "row"))
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(first.alias("f"), *[F.first(c).alias(c) for c in ("n_shingles", "keys", "n_own", *_MARKS)])
    classes = materialise(classes.select("set_id", "f.doc", "n_shingles", "keys", "n_own", *_MARKS, F.monotonically_increasing_id().alias("node")), "classes")
    keys = classes.select("node", "n_own", F.posexplode("keys").alias("at", "key")).select("key", "node", (F.col("at") < F.col("n_own")).alias("own"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 AND own").select("key", "n")
    members = materialise(keys.select("key", "node").join(shared, "key"), "members")
    known = classes.select("node", "n_shingles", *_MARKS)
    one, two = (known.select(F.col("node").alias(x), F.struct("n_shingles", *_MARKS).alias(f"_{x}")) for x in "ab")
    pairs = materialise(head_pairs(members).join(one, "a").join(two, "b").where(_near("_a", "_b", num, den)).select("a", "b"), "pairs")
    nodes = members.select("node").distinct()
    sets = materialise(full_sets(docs, classes.select("node", "set_id", "doc").join(nodes, "node", "left_semi"), doc_id, text, SHINGLE), "sets")
    links = materialise(verified(pairs, sets, num, den).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    comp = materialise(nodes.join(components(links), "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "comp")
    more = materialise(verified(_across(members, comp, known, num, den), sets, num, den), "links")
    if not more.isEmpty():
        comp = merged_by(comp, more)
    named = classes.select("node", "set_id", "doc").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return labelled(rows, named.select("set_id", "doc", "comp"))
