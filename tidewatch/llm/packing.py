"""Best-fit packing with certified bin counts.

Documents become ids, an end id is added, and only documents above the capacity are cut: full pieces fill a sequence each, the first
piece holds the rest. These rests are the items to pack. Each partition of items packs by best-fit decreasing; dual feasible
functions give a lower bound on its bins. A partition whose bins meet the bound is certified and final. One with a gap keeps its full
bins and gives the documents of all others into an exchange, where they meet those of other partitions, are dealt into fewer
partitions and packed again, until a single partition is left or a round has placed less than `SHRINK` of what it got. The last round
keeps all bins of all its partitions, so every item is placed; a round that returns fewer items than it got raises an error.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each on its own; a text longer than the capacity
is cut as said; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, materialise

CAPACITY, END = 1024, 2
#: Items that one partition packs.
ITEMS = 8_000
#: Share of its items that a round must place for another exchange after the next; the most parts that a bin is rounded to in the bound.
SHRINK, PARTS = 0.25, 20
PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"


class Ids:
    """Text -> little-endian unsigned 32-bit ids, by a byte-level tokenizer's JSON file."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"] if x["special"]}
        back = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.coder = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)

    def of(self, text: str) -> np.ndarray:
        special = any(s in text for s in self.special)
        return self.coder.encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=()).astype("<u4", copy=False)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself if printable, else the next free code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pieces_of(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each piece of each row of docs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, last = kept(("ids", path, pattern), lambda: Ids(path, pattern)), np.array([end], "<u4")
        for batch in batches:
            rows = []
            for doc, body in zip(batch["doc_id"], batch["text"], strict=True):
                raw = np.append(ids.of(body or ""), last)
                n = len(raw)
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                rows += [(doc, k, x, y - x, zlib.crc32(raw[x:y])) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInPandas(run, PIECE).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the dual feasible functions that round sizes above capacity - t up to capacity and those below t down to 0, and of these followed by rounding to k-ths of a bin."""
    if not len(sizes):
        return 0
    size = np.bincount(sizes, minlength=capacity + 1)
    number = np.concatenate([[0], np.cumsum(size)])
    t = np.arange(0, capacity // 2 + 1)
    x = np.arange(capacity + 1)
    best = 0
    for k in range(PARTS + 1):
        # k = 0: sizes as they are. Else x counts floor((k + 1) x) / k bins, and x itself where (k + 1) x is whole.
        scale = max(1, k)
        worth = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity) if k else x
        mass = np.concatenate([[0], np.cumsum(size * worth)])  # mass[x]: of sizes below x
        total = (number[-1] - number[capacity - t + 1]) * capacity * scale + (mass[capacity - t + 1] - mass[t])
        best = max(best, int(-(-total.max() // (capacity * scale))))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, fill of each bin. Open bins hang at their free space; a bit mask finds the least that fits."""
    order = np.argsort(-sizes, kind="stable")
    at, offset, fill = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order.tolist():
        s = int(sizes[i])
        fits = mask >> s
        if fits:
            space = s + ((fits & -fits).bit_length() - 1)
            b = free[space].pop()
            if not free[space]:
                mask &= ~(1 << space)
        else:
            b, space = len(fill), capacity
            fill.append(0)
        at[i], offset[i] = b, fill[b]
        fill[b] += s
        if left := space - s:
            free[left].append(b)
            mask |= 1 << left
    return at, offset, np.array(fill, np.int64)


def pack(items: DataFrame, capacity: int = CAPACITY, per_group: int = ITEMS) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid long, length long), none above capacity."""
    placed = None
    todo = items.select("uid", "length")
    left, before = todo.count(), None
    for round_ in count():
        groups = max(1, left // per_group)
        final = groups == 1 or (before is not None and left > (1 - SHRINK) * before)

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["length", "uid"], ascending=[False, True])
            at, offset, fill = best_fit(pdf["length"].to_numpy(np.int64), capacity)
            certified = len(fill) <= lower_bound(pdf["length"].to_numpy(np.int64), capacity)
            done = np.full(len(pdf), True) if certified or final else fill[at] == capacity
            return pd.DataFrame({"uid": pdf["uid"], "length": pdf["length"], "sequence_id": (round_ << 56) + (int(key[0]) << 28) + at, "offset": offset, "done": done})

        dealt = todo.withColumn("g", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(groups)).cast("long"))
        got = materialise(dealt.groupBy("g").applyInPandas(run, "uid long, length long, sequence_id long, offset long, done boolean"), f"packed-{round_}")
        if got.count() != left:
            raise RuntimeError(f"round {round_} was given {left} items and returned {got.count()}")
        now = got.where("done").select("uid", "sequence_id", "offset")
        placed = now if placed is None else placed.unionByName(now)
        if final:
            break
        todo = got.where("NOT done").select("uid", "length")
        left, before = todo.count(), left
    return placed


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text", per_group: int = ITEMS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece. Full pieces have negative sequence ids."""
    pieces = materialise(pieces_of(docs, path, pattern, capacity, end, doc_id, text).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select("*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    return full.unionByName(rest.join(pack(rest, capacity, per_group), "uid")).drop("uid")


def packed(docs: DataFrame, name: str = "byte_bpe_50k.json") -> DataFrame:
    """`pack_documents` with the public tokenizer `name`."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(name), public_tokenizers.PATTERN)
