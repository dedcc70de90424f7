"""How far the word use of each source of a language lies from its other sources and from the whole language.

A term's price in a group depends on its count there alone. So each group has one indicator column for each count level that its terms
have, and the product of these columns with their transpose holds, for any two groups, the joint table of their levels: how many terms
have count a here and b there. Divergences are priced from these tables. The product is made in blocks of `TERMS` terms and `GROUPS` by
`GROUPS` groups; integers only, so it is exact, and a row of the indicator matrix has one 1 a group, so a block's product is a count of
level pairs.

Texts are counted in Python workers that hold at most `HELD` distinct (group, term) pairs before they pass their sums on; no row stands
for a single word. All groups of a language meet in pairs, since that is the result.

Defined cases: null text, lang or source is an empty string; a text without terms leaves its group with price 1 + floor(5e9 / 5V) of each
term; languages without a kept term give value 0 for each pair and no term rows; ties are ordered by the item's UTF-8 bytes; very long
texts count whole; equal rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: A language keeps terms that so many of its documents hold; term rows are given to this rank.
LEAST_DOCS, MOST_RANK = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
TERMS, GROUPS = 2048, 64
HELD = 400_000
#: Languages whose sums are broadcast to their terms; beyond it they are shuffled to them.
BROADCAST_LANGS = 10_000
#: Bytes of letters and of code points beyond ASCII stay, A-Z in lower case; all others part terms.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; a row with a null term for each group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pd.DataFrame]:
            for (a, b), (n, d) in words.items():
                spots = list(n)
                yield pd.DataFrame({"lang": a, "source": b, "term": [None, *(x.decode() for x in spots)], "n": [0, *(n[x] for x in spots)], "docs": [0, *(d[x] for x in spots)]})
            words.clear()

        held = 0
        for batch in batches:
            for a, b, x in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                n, d = words.setdefault((a, b), (Counter(), Counter()))
                held -= len(n)
                found = terms_of(x)
                n.update(found)
                d.update(set(found))
                held += len(n)
                if held > HELD:
                    yield from out()
                    held = 0
        yield from out()

    given = docs.select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(y) for x, y in ((lang, "lang"), (source, "source"), (text, "text"))])
    parts = given.mapInPandas(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(n: Column, all_n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (all_n + SMOOTH * v)), in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide(F.lit(SCALE)) * (wide(n) + SMOOTH), wide(all_n) + wide(F.lit(SMOOTH)) * wide(v))


def levels(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The count levels of a group, and for each term which of its indicator columns holds the 1."""
    return np.unique(column, return_inverse=True)


def joint(here: np.ndarray, there: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Product of one group's indicator columns, transposed, with all of a block: (row, column, how many terms) of its entries that aren't 0.

    here: each term's column in the group; there: terms x groups, each term's columns in the block, numbered over all its groups.
    """
    spots, many = np.unique(here[:, None] * np.int64(width) + there, return_counts=True)
    return spots // width, spots % width, many


def block_product(left: np.ndarray, right: np.ndarray, left_n: list[int], right_n: list[int], v: int, same: bool) -> np.ndarray:
    """Values of the pairs of a block, from its count matrices (terms x groups): sum of |p - q| over its terms. same: only pairs above the diagonal."""

    def coded(counts: np.ndarray, all_n: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, price, owner, at = np.empty_like(counts), [], [], 0
        for g in range(counts.shape[1]):
            level, own = levels(counts[:, g])
            place[:, g] = own + at
            price += [1 + SCALE * (int(c) + SMOOTH) // (all_n[g] + SMOOTH * v) for c in level]
            owner += [g] * len(level)
            at += len(level)
        return place, np.array(price, np.int64), np.array(owner, np.int64)

    p_place, p, p_owner = coded(left, left_n)
    q_place, q, q_owner = coded(right, right_n)
    out = np.zeros((left.shape[1], right.shape[1]), np.int64)
    for g in range(left.shape[1]):
        first = g + 1 if same else 0
        if first < right.shape[1]:
            a, b, many = joint(p_place[:, g], q_place[:, first:], len(q))
            np.add.at(out[g], q_owner[b], np.abs(p[a] - q[b]) * many)
    return out


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, most_rank: int = MOST_RANK) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's distance to each other source of its language, and the terms that it uses above the language."""
    every = materialise(counts(docs, text, lang, source), "counts")
    kept = every.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs)
    kept = materialise(kept.select("lang", "term", "total"), "kept")
    langs = materialise(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n")), "langs")
    langs = F.broadcast(langs) if langs.count() <= BROADCAST_LANGS else langs
    inside = materialise(every.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "inside")
    own = inside.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = every.where("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialise(groups.select("lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"), number.alias("g")), "groups")
    return _pairs(kept, inside, langs, groups).unionByName(_terms(inside, groups, most_rank))


def _pairs(kept: DataFrame, inside: DataFrame, langs: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = F.ceil(F.col("v") / TERMS).cast("long")
    spot = Window.partitionBy("lang", "b")
    numbered = kept.join(langs, "lang").withColumn("b", F.pmod(F.xxhash64("term"), blocks))
    numbered = numbered.select("lang", "term", "b", (F.row_number().over(spot.orderBy("term")) - 1).alias("t"))
    size = numbered.groupBy("lang", "b").agg(F.count("*").alias("size"))
    # A block of groups meets itself and each other one of its language, in every block of terms.
    own = groups.withColumn("own", F.floor(F.col("g") / GROUPS))
    most = own.groupBy("lang").agg(F.max("own").alias("last"))
    own = own.join(most, "lang")
    meets = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    entries = inside.join(numbered, ["lang", "term"]).join(own.select("lang", "source", "g", "own", "last"), ["lang", "source"])
    entries = entries.select("lang", "b", "g", "own", "t", "n", meets)
    heads = own.where("v > 0").select("lang", "g", "own", F.col("group_n").alias("n"), "v", meets)
    heads = heads.join(size, "lang").select("lang", "b", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "g", F.lit(-1).cast("long").alias("t"), "n", "v", "size")
    entries = entries.select("lang", "b", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "g", F.col("t").cast("long").alias("t"), "n", F.lit(None).cast("long").alias("v"), F.lit(None).cast("long").alias("size"))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        at = part["t"].to_numpy()
        head = part[at < 0].sort_values("g")
        v, size = int(head["v"].iloc[0]), int(head["size"].iloc[0])
        names, all_n = head["g"].to_numpy(), head["n"].tolist()
        rows = part[at >= 0]
        full = np.zeros((size, len(names)), np.int64)
        full[rows["t"].to_numpy(), np.searchsorted(names, rows["g"].to_numpy())] = rows["n"].to_numpy()
        same, cut = key[2] == key[3], int(np.searchsorted(names, (key[2] + 1) * GROUPS))
        left, right = (slice(None), slice(None)) if same else (slice(0, cut), slice(cut, None))
        value = block_product(full[:, left], full[:, right], all_n[left], all_n[right], v, same)
        x, y = np.triu_indices(len(names), 1) if same else (k.ravel() for k in np.indices(value.shape))
        return pd.DataFrame({"lang": key[0], "g": names[left][x], "h": names[right][y], "value": value[x, y]})

    parts = entries.unionByName(heads).groupBy("lang", "b", "i", "j").applyInPandas(run, "lang string, g long, h long, value long")
    total = materialise(parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value")), "values")
    both = total.unionByName(total.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    pairs = groups.select("lang", "source", "g").join(groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h")), "lang").where("g <> h")
    told = pairs.join(both, ["lang", "g", "h"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    return _ranked(told, "pair")


def _terms(inside: DataFrame, groups: DataFrame, most_rank: int) -> DataFrame:
    rows = inside.join(groups, ["lang", "source"])
    p, q = _price(F.col("n"), F.col("group_n"), F.col("v")), _price(F.col("total"), F.col("lang_n"), F.col("v"))
    above = rows.select("lang", "source", F.col("term").alias("item"), (p - q).cast("long").alias("value")).where("value > 0")
    return _ranked(above, "term").where(F.col("rank") <= most_rank)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))
