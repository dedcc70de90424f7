"""MinHash near-dedup with odd sketches.

Each text's shingle set gives `ROWS * BANDS` MinHash samples. Bands of ROWS samples retrieve candidates: a pair of similarity 0.85
shares no band with a probability of (1 - 0.85^5)^25, below 5e-7. The samples are also folded into a bitmap of 256 bits whose bits
count parity (odd sketch); the population count of the XOR of two bitmaps estimates high similarities precisely, and pairs whose
count exceeds `MOST_BITS` (estimate below 0.6) are not read in full. All others are verified on their full sets.

Equal sets form a class first, so copies cost one row each. In a bucket, members are verified against two heads (the one that meets
most others in all its buckets, and one by hash), not against each other; links merge components. For buckets that then still hold more than one component, an exact filter finds the pairs to verify, so
that no link is lost and no group is paired with itself: each set's shingles are ordered from rare to frequent, and two sets of that
similarity share one of the first 15 % and from there on have enough left; of the members that share a shingle, those in its most
frequent component are compared with the others only. Components come from alternating star contractions, the second time over
components already found.

Defined cases: null or empty text has no shingles, links with nothing and is kept; fewer words than a shingle are one shingle; rows
with equal text are in one component; repeated ids are judged each row by its text; a null doc_id is never the smallest of a component
unless no row of it has an id; such a component without any id keeps component_id null, and `kept` is true for all its rows in
`near_duplicates`, while `keep_one` leaves one of them; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Generations, blocks, kept, materialise

SHINGLE, NUM, DEN = 5, 85, 100
ROWS, BANDS = 5, 25
BITS, MOST_BITS = 256, 70
#: Ids that are broadcast to pick out candidate texts; beyond it the texts are shuffled.
BROADCAST_IDS = 200_000

_mask = np.uint64(0xFFFFFFFFFFFFFFFF)
_rng = np.random.default_rng(20240117)
_A = _rng.integers(1, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)
_W = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes() -> Generations:
    """This worker's hashes of words met."""
    return kept("word hashes", lambda: Generations(xxhash.xxh3_64_intdigest, each=150))


def shingle_sets(texts: list[str | None], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The set of each text as sorted distinct 64-bit hashes of `width` words (SHINGLE at most); empty without words. bytes.lower and bytes.split know ASCII alone."""
    words = [(x or "").encode().lower().split() for x in texts]
    known = hashes()
    known.turn()
    n = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((known[w] for ws in words for w in ws), np.uint64, int(n.sum()))
    del words
    end = max(0, len(flat) - width + 1)
    rolled = _mix(reduce(np.add, (_mix(flat[k : k + end] + np.uint64(k)) * _W[k] for k in range(width)))) if end else flat[:0]
    for a, k in zip((np.cumsum(n) - n).tolist(), n.tolist(), strict=True):
        if k >= width:
            yield np.unique(rolled[a : a + k - width + 1])
        elif k:
            short = flat[a : a + k]
            yield _mix(np.array([sum(int(_mix(short[i : i + 1] + np.uint64(i))[0]) * int(_W[i]) for i in range(k)) + k & int(_mask)], np.uint64))
        else:
            yield flat[:0]


def samples_of(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    least = np.full(len(_A), _mask)
    for a in range(0, len(shingles), 4096):
        least = np.minimum(least, (np.multiply.outer(_A, shingles[a : a + 4096]) + _B[:, None]).min(axis=1))
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of how many samples fall on each of BITS bits, as 64-bit words."""
    spot = _mix(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BITS)
    return np.packbits((np.bincount(spot.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def estimate(bits: int, samples: int = ROWS * BANDS, size: int = BITS) -> float:
    """Similarity that a population count of the XOR of two sketches stands for."""
    return 1 - np.log(max(1e-9, 1 - 2 * bits / size)) / np.log(1 - 2 / size) / (2 * samples)


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


SIGNED = f"row long, doc_id string, n_shingles long, set_id binary, bands array<long>, {', '.join(f's{i} long' for i in range(BITS // 64))}"


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(row, doc_id, n_shingles, set_id, bands, s0..s3) for each row; without shingles set_id and bands are null and the sketch 0. row: a unique number, in the column of that name if there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in blocks([x or "" for x in batch["text"]], 1_000_000):
                rows = []
                for s in shingle_sets(list(batch["text"][a:b])):
                    if not len(s):
                        rows.append((0, None, None, *[0] * (BITS // 64)))
                        continue
                    m = samples_of(s)
                    bands = _mix(reduce(np.add, (_mix(m.reshape(BANDS, ROWS)[:, r]) * _W[r % SHINGLE] for r in range(ROWS))) + np.arange(BANDS, dtype=np.uint64))
                    rows.append((len(s), digest(s), bands.view(np.int64), *odd_sketch(m).tolist()))
                out = pd.DataFrame(rows, columns=["n_shingles", "set_id", "bands", *[f"s{i}" for i in range(BITS // 64)]])
                out.insert(0, "row", batch["row"][a:b].to_numpy())
                out.insert(1, "doc_id", batch["doc_id"][a:b].to_numpy())
                yield out

    key = F.col(row) if row else F.monotonically_increasing_id()
    return docs.select(key.alias("row"), F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(run, SIGNED).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _differ(a: str, b: str) -> Column:
    return reduce(Column.__add__, (F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(BITS // 64)))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over edges (u, v), for each node in one. Alternates star contractions until nothing changes."""
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        now = materialise(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose full sets have den * intersection >= num * union."""
    one, two = sets.select(F.col("node").alias("b"), F.col("set").alias("y")), sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(one, "b").join(two, "a").where(den * both >= num * (F.size("x") + F.size("y") - both)).select("a", "b")


def _rare_first(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(shingle, node, size, pos) for the part of each set, ordered from rare to frequent, of which two similar sets share a shingle; without shingles of one set only."""
    rows = sets.select("node", F.size("set").alias("size"), F.explode("set").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("n"))
    pos = F.row_number().over(Window.partitionBy("node").orderBy("n", "shingle"))
    first = F.col("size") - F.ceil(F.lit(num) * F.col("size") / F.lit(den)) + 1
    return rows.join(often, "shingle").withColumn("pos", pos).where((F.col("pos") <= first) & (F.col("n") > 1)).select("shingle", "node", "size", "pos")


def _across(rare: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components that share a shingle of `rare`, can have enough in common and whose sketches are near.

    Rows of a shingle's most frequent component (it may hold a third of all) meet the rows of other components only, never each other.
    """
    counts = rare.groupBy("shingle", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("shingle").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("comps")).where("comps > 1").select("shingle", "main")
    told = materialise(rare.join(main, "shingle"), "told")
    least = F.ceil(F.lit(num) * (F.col("x.size") + F.col("y.size")) / F.lit(num + den))
    may = 1 + F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos")) >= least
    once = (F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    met = told.where("comp <> main").alias("x").join(told.alias("y"), "shingle").where((F.col("x.comp") != F.col("y.comp")) & once & may & (_differ("x.mark", "y.mark") <= MOST_BITS))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, width: int = SHINGLE) -> DataFrame:
    """(node, set) of the wanted classes (node, set_id, doc), read anew from one text of each."""
    wanted = wanted.select("node", "set_id", F.col("doc").alias("_doc"))
    ids = wanted.where("_doc IS NOT NULL").select("_doc").distinct()
    small = ids.count() <= BROADCAST_IDS
    every = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("string").alias("text"))
    own = every.join(F.broadcast(ids) if small else ids, "_doc", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in blocks([x or "" for x in batch["text"]], 1_000_000):
                sets = list(shingle_sets(list(batch["text"][a:b]), width))
                yield pd.DataFrame({"set_id": [digest(s) for s in sets], "set": [s.view(np.int64) for s in sets]})

    found = own.select("text").mapInPandas(run, "set_id binary, set array<long>")
    if not wanted.where("_doc IS NULL").isEmpty():  # texts of rows without an id are found by their sets
        found = found.unionByName(every.where("_doc IS NULL").select("text").mapInPandas(run, "set_id binary, set array<long>"))
    return found.join(wanted.select("node", "set_id"), "set_id").groupBy("node").agg(F.first("set").alias("set"))


def head_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the members of each bucket (key, node, n) with its two heads: the text that others are edits of meets most of them in its buckets, so it is the first head, one by hash the second.

    The second is another text than the first: so buckets of two and of three have all their pairs here.
    """
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    by_hash = F.struct(F.xxhash64("node").alias("h"), "node")
    found = members.join(central, "node").groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("first"), F.min(by_hash)["node"].alias("lo"), F.max(by_hash)["node"].alias("hi"))
    heads = found.select("key", F.array("first", F.when(F.col("lo") != F.col("first"), F.col("lo")).otherwise(F.col("hi"))).alias("heads"))
    pairs = members.join(heads, "key").select("node", F.explode("heads").alias("head")).where("node <> head")
    return pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def merged_by(comp: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after links (a, b) between nodes of different components."""
    over = [comp.select(F.col("node").alias(x), F.col("comp").alias(y)) for x, y in (("a", "u"), ("b", "v"))]
    merged = components(links.join(over[0], "a").join(over[1], "b").select("u", "v")).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return materialise(comp.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "comp")


def labelled(signed: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each signed row, by the component of its class."""
    least = named.groupBy("comp").agg(F.min("doc").alias("component_id"))
    label = named.join(least, "comp").select(F.col("set_id").alias("key"), "component_id")
    # Rows without words have no class; each gets a key of its own, so that they don't meet in one task.
    out = signed.select("doc_id", "n_shingles", F.coalesce("set_id", F.encode(F.col("row").cast("string"), "utf-8")).alias("key")).join(label, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The `signatures` of docs, and (set_id, doc, row, comp) of each class of equal sets: its smallest doc_id (null if it has none), its first row (by doc_id, then row) and its component."""
    sketch = [f"s{i}" for i in range(BITS // 64)]
    signed = materialise(signatures(docs, doc_id, text, row), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), "row"))
    classes = signed.where("n_shingles > 0").groupBy("set_id").agg(first.alias("f"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", *sketch)])
    classes = materialise(classes.select("set_id", "f.doc", "f.row", "n_shingles", "bands", *sketch, F.monotonically_increasing_id().alias("node")), "classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(keys.join(shared, "key"), "members")
    pairs = head_pairs(members)
    known = classes.select("node", "n_shingles", *sketch)
    one, two = (known.select(F.col("node").alias(x), F.struct("n_shingles", *sketch).alias(f"_{x}")) for x in "ab")
    sizes = [F.col(f"{x}.n_shingles") for x in ("_a", "_b")]
    close = (den * F.least(*sizes) >= num * F.greatest(*sizes)) & (_differ("_a", "_b") <= MOST_BITS)
    pairs = materialise(pairs.join(one, "a").join(two, "b").where(close).select("a", "b"), "pairs")
    nodes = members.select("node").distinct()
    sets = materialise(full_sets(docs, classes.join(nodes, "node", "left_semi"), doc_id, text), "sets")
    links = materialise(verified(pairs, sets, num, den).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    own = components(links)
    comp = materialise(nodes.join(own, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "comp")
    # Buckets of two have been settled by their heads.
    now = members.where(F.col("n") > 2).select("key", "node").join(comp, "node")
    open_ = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_ = now.join(open_, "key", "left_semi").select("node", "comp").distinct()
    open_ = known.select("node", F.struct(*sketch).alias("mark")).join(open_, "node")
    rare = _rare_first(sets.join(open_.select("node"), "node", "left_semi"), num, den)
    rare = materialise(rare.join(open_, "node"), "rare")
    more = materialise(verified(_across(rare, num, den), sets, num, den), "links")
    if not more.isEmpty():
        comp = merged_by(comp, more)
    named = classes.select("node", "set_id", "doc", "row").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return signed, named.select("set_id", "doc", "row", "comp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs; kept: doc_id is the smallest of its component."""
    signed, named = grouped(docs, doc_id, text, num, den)
    return labelled(signed, named).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of docs, one of each component: the first by doc_id (those with an id first), then by a written row number. Rows without words all stay."""
    numbered = materialise(docs.withColumn(fresh := _fresh("_row", docs), F.monotonically_increasing_id()), "numbered")
    signed, named = grouped(numbered, row=fresh)
    first = named.groupBy("comp").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row"))["row"].alias(fresh)).select(fresh)
    empty = signed.where("n_shingles = 0").select(F.col("row").alias(fresh))
    return numbered.join(first.unionByName(empty), fresh, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def _fresh(name: str, df: DataFrame) -> str:
    """name, with as many underscores as it takes not to be a column of df."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name
