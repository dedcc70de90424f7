"""SimHash fingerprints and the search within a Hamming radius.

Terms are pairs of adjacent words (the word itself if a text has only one), A-Z lower-cased, each weighted by the square root of
its count. A term's hash votes on `BITS` signed bits with its weight; the sign of each sum is a bit of the fingerprint. For a search, fingerprints
are cut into `blocks` blocks; two within `radius` bits differ in at most `radius` of them, so they agree on all blocks of at least
one permuted table, whose key is a choice of `blocks - radius` blocks. Equal fingerprints count as one in the search.

The next document in ascending doc_id comes from one range-bucketed, sorted shuffle of the texts; the first text of a bucket is also
sent to the bucket before it, and the first of all to the last.

Defined cases: a null text is empty; an empty text has the fingerprint of zeros; equal texts have equal fingerprints; rows with the
same whole-number doc_id are ordered by a checksum of their texts, then by text, of other ids by text; ids keep their type, texts are
ordered by their bytes; a null doc_id comes first; very long texts count whole; the next of a single row is itself; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .near_dedup import _mix, hashes

BITS = 128
#: Rows of one range bucket, and how many buckets there may be.
ROWS_PER_BUCKET, MOST_BUCKETS = 2_000, 10_000
_LOW = -(2**63)
#: The eight signed votes of each value of a byte.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1


def fingerprint(text: str) -> bytes:
    words = text.encode().lower().split()
    if not words:
        return bytes(BITS // 8)
    known = hashes()
    known.turn()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    terms = _mix(h[:-1] * np.uint64(3) + _mix(h[1:])) if len(h) > 1 else _mix(h)
    terms, count = np.unique(terms, return_counts=True)
    weight = np.sqrt(count)
    votes = np.zeros(BITS)
    for k in range(BITS // 64):
        hashed = _mix(terms + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)).view(np.uint8).reshape(-1, 8)
        for j in range(8):  # a byte's value tells its 8 votes: weights are added by value first
            votes[64 * k + 8 * j : 64 * k + 8 * j + 8] = np.bincount(hashed[:, j], weight, 256) @ _SIGNS
    return np.packbits(votes >= 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / (8 * len(a))


def _exact(x: Decimal) -> Column:
    return F.lit(str(x)).cast("decimal(38,0)")


def _order(doc_id: Column, kind: str, text: Column) -> Column:
    """A number that never falls as ids rise. Rows of one whole-number id follow by a checksum of their texts, so that a hot id falls in many buckets; of other ids the first eleven bytes count."""
    wide = lambda c: c.cast("decimal(38,0)")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        first, second = doc_id.cast("bigint"), F.crc32(text.cast("binary"))
    else:
        first, second = (F.conv(F.rpad(F.hex(F.substring(doc_id.cast("string").cast("binary"), at, n)), 2 * n, "0"), 16, 10).cast("bigint") for at, n in ((1, 7), (8, 4)))
    return (wide(F.coalesce(first, F.lit(_LOW))) * F.lit(2**32) + wide(F.coalesce(second, F.lit(0)))).cast("decimal(38,0)")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs(doc_id string, text) in range buckets: rows (bucket, halo, key, doc_id, text), those of a bucket together and sorted, then with halo = 1 the row that follows its last."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    key = _order(F.col("doc_id"), docs.schema[doc_id].dataType.simpleString(), F.col("text"))
    n = min(MOST_BUCKETS, max(1, own.count() // ROWS_PER_BUCKET))
    cuts = own.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"] if n > 1 else None
    cuts = sorted(set(cuts or []))
    side = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + side] for i in range(0, len(cuts), side)]

    def below(at: Column, bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= at))

    if cuts:
        coarse = below(key, F.array(*[_exact(g[0]) for g in groups])) - 1
        fine = below(key, F.get(F.array(*[F.array(*map(_exact, g)) for g in groups]), F.greatest(coarse, F.lit(0))))
        bucket = F.when(coarse < 0, 0).otherwise(coarse * side + fine)
    else:
        bucket = F.lit(0)
    firsts = own.select(bucket.alias("bucket"), key.alias("key")).groupBy("bucket").agg(F.min("key").alias("key")).collect()
    firsts = sorted((r["bucket"], r["key"]) for r in firsts)
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    ahead = F.array(*[F.lit(before.get(b, 0)) for b in range(len(cuts) + 1)])
    first = key.isin([_exact(k) for _, k in firsts]) if firsts else F.lit(False)
    here = F.struct(F.col("bucket"), F.lit(0).alias("halo"))
    there = F.struct(F.get(ahead, F.col("bucket")).alias("bucket"), F.lit(1).alias("halo"))
    rows = own.withColumn("bucket", bucket.cast("int")).select(F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))).alias("to"), key.alias("key"), "doc_id", "text")
    rows = rows.select("to.*", "key", "doc_id", "text").repartition("bucket").sortWithinPartitions("bucket", "halo", "key", "doc_id", "text")
    return rows.withColumn("doc_id", F.col("doc_id").cast("string"))


SCHEMA = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row; edited: the last half replaced by the start of the next text."""

    def row(doc: str | None, own: str, mark: bytes, nxt: str, next_mark: bytes) -> tuple:
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        e = fingerprint(edited)
        return doc, len(own), hashlib.sha256(edited.encode()).hexdigest(), mark.hex(), e.hex(), likeness(mark, e), likeness(mark, next_mark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            out = []
            for bucket, halo, doc, text in zip(batch["bucket"], batch["halo"], batch["doc_id"], batch["text"], strict=True):
                if halo and (last is None or last[0] != bucket):
                    continue  # another row with the first doc_id; the first has been used
                mark = fingerprint(text)
                if last is not None and last[0] == bucket:
                    out.append(row(*last[1:], text, mark))
                last = None if halo else (bucket, doc, text, mark)
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return with_next(docs, doc_id, text).mapInPandas(run, SCHEMA).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _words64(hex_: str) -> list[Column]:
    """A hexadecimal fingerprint as signed 64-bit numbers."""
    half = lambda at: F.conv(F.substring(hex_, at, 8), 16, 10).cast("long")
    return [F.shiftleft(half(at), 32).bitwiseOR(half(at + 8)) for at in range(1, BITS // 4, 16)]


def within_radius(marks: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5, mark: str = "fingerprint") -> DataFrame:
    """(query, found, bits): all pairs of a fingerprint of queries and one of marks that differ in at most radius bits, each pair once."""
    edge = [round(i * BITS / 4 / blocks) for i in range(blocks + 1)]
    part = [F.substring("m", edge[i] + 1, edge[i + 1] - edge[i]) for i in range(blocks)]
    tables = list(combinations(range(blocks), blocks - radius))
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.concat(*[part[i] for i in c]).alias("k")) for t, c in enumerate(tables)])).alias("e")

    def dealt(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(mark).alias("m")).distinct().select("m", *[w.alias(f"w{i}") for i, w in enumerate(_words64("m"))], keys).select("e.*", F.col("m").alias(name), *[F.col(f"w{i}").alias(f"{name}{i}") for i in range(BITS // 64)])

    bits = sum(F.bit_count(F.col(f"query{i}").bitwiseXOR(F.col(f"found{i}"))) for i in range(BITS // 64))
    return dealt(queries, "query").join(dealt(marks, "found"), ["t", "k"]).where(bits <= radius).select("query", "found", bits.alias("bits")).distinct()


def marked(docs: DataFrame, every: int = 50, radius: int = 3) -> DataFrame:
    """`fingerprints` with near_queries: of the documents whose id is divisible by `every`, how many have a fingerprint within radius."""
    found = materialise(fingerprints(docs), "fingerprints")
    queries = found.where(F.expr("try_cast(doc_id AS BIGINT)") % every == 0)
    asked = queries.groupBy("fingerprint").agg(F.count("*").alias("n"))
    pairs = within_radius(found, queries, radius)
    near = pairs.join(asked, pairs["query"] == asked["fingerprint"]).groupBy("found").agg(F.sum("n").alias("near_queries"))
    return found.join(near, found["fingerprint"] == near["found"], "left").select(*[found[c] for c in found.columns], F.coalesce("near_queries", F.lit(0).cast("long")).alias("near_queries"))
