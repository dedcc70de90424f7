"""Byte-level BPE by recursive DuckDB queries, one database a partition.

The tokenizer's pattern cuts texts into pieces. Pieces that a worker has not met yet go to DuckDB, one row for each token position with
its token and the next one: rows join the merge table on that pair, each piece's leftmost pair of least rank is contracted, and the
query recurs until no pair is left. A recursion holds the rows of all its steps, so it takes at most `STEPS`, and fewer where that
would be more than `ROWS` rows; what has a pair left then goes on in the next recursion. Decoding joins ids to their bytes and puts them together by position with an ordered aggregate.

A long piece is laid out in units of `UNIT` longest tokens each. No token reaches over a unit, so what happens beyond the neighbours
of a unit cannot touch it before its own least pair is contracted: a step contracts every pair that is least in its unit and in both
neighbours. A piece of one unit, as nearly all are, has one such pair, the leftmost of least rank; the results are the same.

Defined cases: null or empty text has no tokens (0, digests of the empty string); repeated texts give equal rows; very long texts
and pieces are whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, blocks, kept

#: Token positions that one recursion starts from at most (a longer piece goes alone), and a unit's length in longest tokens.
ROUND, UNIT = 500_000, 4
#: Steps of one recursion, and rows that all its steps may hold.
STEPS, ROWS = 32, 16_000_000
#: Bytes of pieces that a worker remembers in each of two generations, and what an entry takes besides its piece.
MEMORY, ENTRY = 96_000_000, 240

#: k numbers the tokens of unit u of piece w; nx is the token after it. `spot` is contracted into the row after it, which may be the first of the next unit.
ENCODE = """
WITH RECURSIVE step(it, w, units, u, k, tok, nx) AS (
    SELECT 0, w, units, u, k, tok, nx FROM state
    UNION ALL
    (WITH least AS (
        SELECT w, u, max(k) AS top, min((CAST(merged AS BIGINT) << 32) + k) AS best
        FROM step LEFT JOIN merges ON pair = (CAST(tok AS BIGINT) << 32) + nx WHERE units > 1 GROUP BY w, u
    ), chosen AS (
        SELECT w, u, top, CASE WHEN (best >> 32) < coalesce(lag(best) OVER o >> 32, 2147483647) AND (best >> 32) <= coalesce(lead(best) OVER o >> 32, 2147483647) THEN best END AS best
        FROM least WINDOW o AS (PARTITION BY w ORDER BY u) QUALIFY count(best) OVER (PARTITION BY w) > 0
    ), effect AS (
        SELECT u, top, best,
            CASE WHEN lag(best & 4294967295) OVER o = lag(top) OVER o THEN CAST(lag(best) OVER o >> 32 AS INTEGER) END AS head,
            CASE WHEN lead(best & 4294967295) OVER o = 0 THEN CAST(lead(best) OVER o >> 32 AS INTEGER) END AS tail
        FROM chosen WINDOW o AS (PARTITION BY w ORDER BY u)
        UNION ALL  -- a unit without neighbours
        SELECT u, NULL, min((CAST(merged AS BIGINT) << 32) + k), NULL, NULL
        FROM step JOIN merges ON pair = (CAST(tok AS BIGINT) << 32) + nx WHERE units = 1 GROUP BY u
    ), spots AS (SELECT u, top, coalesce(CAST(best & 4294967295 AS INTEGER), -9) AS spot, CAST(best >> 32 AS INTEGER) AS made, head, tail FROM effect)
    SELECT it + 1, w, units, u, CASE WHEN spot >= 0 AND k > spot THEN k - 1 ELSE k END,
        CASE WHEN k = spot + 1 THEN made WHEN k = 0 THEN coalesce(head, tok) ELSE tok END,
        CASE WHEN k = spot - 1 THEN made WHEN k = top THEN coalesce(tail, nx) ELSE nx END
    FROM step JOIN spots USING (u) WHERE k <> spot AND it < {steps})
)
SELECT it, w, units, u, k, tok, nx FROM step JOIN (SELECT u, max(it) AS it FROM step GROUP BY u) USING (u, it)
"""
#: Ids and decoded bytes of each piece of `coded`, in the order of its positions.
DECODE = """
SELECT w, string_agg(CAST(tok AS VARCHAR), ',' ORDER BY u, k) AS ids, from_hex(string_agg(hex, '' ORDER BY u, k)) AS raw
FROM coded JOIN vocab ON id = tok GROUP BY w
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """One worker's database and what it has encoded so far."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY) -> None:
        self.ranks, self.pattern, self.memory = load_ranks(path), regex.compile(pattern), memory
        self.unit = UNIT * max(map(len, self.ranks))
        self.known: dict[str, tuple[str, bytes]] = {}
        self.before: dict[str, tuple[str, bytes]] = {}
        self.used = 0
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "preserve_insertion_order": False})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.merges = pa.table({"pair": pa.array([(a << 32) + b for a, b, _ in pairs], pa.int64()), "merged": pa.array([m for _, _, m in pairs], pa.int32())})
        self.vocab = pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks])})
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._put("merges", self.merges)
        self._put("vocab", self.vocab)

    def _put(self, name: str, rows: pa.Table) -> None:
        self.con.register("put_in", rows)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM put_in")
        self.con.unregister("put_in")

    def _start(self, pieces: list[bytes], at: np.ndarray) -> pa.Table:
        """Token positions of pieces, those numbered `at`."""
        size = np.array([len(p) for p in pieces], np.int64)
        tok = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        end = np.cumsum(size)
        pos = np.arange(len(tok)) - np.repeat(end - size, size)
        units = -(-size // self.unit)
        u = np.repeat(np.cumsum(units) - units, size) + pos // self.unit
        nx = np.append(tok[1:], np.int32(-1))
        nx[end - 1] = -1
        return pa.table({"w": np.repeat(at, size).astype(np.int32), "units": np.repeat(units, size).astype(np.int32), "u": u.astype(np.int32), "k": (pos % self.unit).astype(np.int32), "tok": tok, "nx": nx})

    def code(self, pieces: list[bytes]) -> list[tuple[str, bytes]]:
        """Of each piece, not empty: the ids joined by commas and the bytes that they decode to."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        known, todo = np.flatnonzero(whole >= 0), np.flatnonzero(whole < 0)
        zero = np.zeros(len(known), np.int32)
        self._put("coded", pa.table({"w": known.astype(np.int32), "u": zero, "k": zero, "tok": whole[known].astype(np.int32)}))
        at = 0
        while at < len(todo):
            size, end = 0, at
            while end < len(todo) and (end == at or size + len(pieces[todo[end]]) <= ROUND):
                size += len(pieces[todo[end]])
                end += 1
            self._put("state", self._start([pieces[i] for i in todo[at:end]], todo[at:end]))
            left = size
            while left:  # what the last step still changed goes on from there
                steps = max(1, min(STEPS, ROWS // left))
                self.con.execute(f"CREATE OR REPLACE TEMP TABLE reached AS {ENCODE.format(steps=steps)}")
                self.con.execute(f"INSERT INTO coded SELECT w, u, k, tok FROM reached WHERE it < {steps}")
                self.con.execute(f"CREATE OR REPLACE TEMP TABLE state AS SELECT w, units, u, k, tok, nx FROM reached WHERE it = {steps}")
                left = self.con.sql("SELECT count(*) FROM state").fetchall()[0][0]
            at = end
        return self._decoded(len(pieces))

    def _decoded(self, n: int) -> list[tuple[str, bytes]]:
        got = self.con.sql(DECODE).to_arrow_table()
        out = [("", b"")] * n
        for i, ids, raw in zip(*(got[c].to_pylist() for c in ("w", "ids", "raw")), strict=True):
            out[i] = ids, raw
        return out

    def decode(self, rows: list[list[int]]) -> list[bytes]:
        """Bytes of each list of ids."""
        n = np.array([len(x) for x in rows], np.int64)
        flat = np.array([t for ids in rows for t in ids], np.int32)
        k = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        self._put("coded", pa.table({"w": np.repeat(np.arange(len(rows)), n).astype(np.int32), "u": np.zeros(len(flat), np.int32), "k": k.astype(np.int32), "tok": flat}))
        return [raw for _, raw in self._decoded(len(rows))]

    def learn(self, pieces: set[str]) -> None:
        """Encode and decode the pieces that are not known yet. A full generation becomes the one before; what is met of that moves over."""
        if self.used > self.memory:
            self.before, self.known, self.used = self.known, {}, 0
        new = []
        for p in pieces - self.known.keys():
            if (got := self.before.get(p)) is None:
                new.append(p)
            else:
                self.known[p] = got
                self.used += ENTRY + len(p)
        for p, got in zip(new, self.code([p.encode() for p in new]) if new else (), strict=True):
            self.known[p] = got
            self.used += ENTRY + len(p)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Of each text the ids joined by commas and the bytes that they decode to."""
        cut = list(map(self.pattern.findall, texts))
        self.learn(set().union(*cut))
        for pieces in cut:
            got = list(map(self.known.__getitem__, pieces))
            yield ",".join([x[0] for x in got]), b"".join([x[1] for x in got])


_blank = regex.compile(r"(?<=\S)(?= \S)")


def sections(text: str, most: int = BLOCK) -> Iterator[str]:
    """text in parts of about `most` code points, cut before blanks with no white space beside them: there the pattern cuts in any case."""
    at = 0
    while len(text) - at > most and (cut := _blank.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and with keep_ids the ids and the decoded bytes, for each row of docs."""
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * keep_ids
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * keep_ids]

    def long_row(e: Encoder, text: str) -> tuple:
        n, ids_sum, raw_sum, every, raws = 0, hashlib.sha256(), hashlib.sha256(), [], []
        for part in sections(text):
            ((ids, raw),) = e.encode([part])
            if ids:
                ids_sum.update((("," if n else "") + ids).encode())
                n += ids.count(",") + 1
            raw_sum.update(raw)
            if keep_ids:
                every += map(int, filter(None, ids.split(",")))
                raws.append(raw)
        return n, ids_sum.hexdigest(), raw_sum.hexdigest(), *((every, b"".join(raws)) if keep_ids else ())

    def row(ids: str, raw: bytes) -> tuple:
        n = ids.count(",") + 1 if ids else 0
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest(), *(([int(i) for i in ids.split(",") if i], raw) if keep_ids else ())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = kept(("bpe", path, pattern), lambda: Encoder(path, pattern))
        for batch in batches:
            texts = ["" if x is None else x for x in batch["text"]]
            for a, b in blocks(texts):
                rows = [long_row(e, texts[a])] if b == a + 1 and len(texts[a]) > BLOCK else [row(*x) for x in e.encode(texts[a:b])]
                yield pd.concat([batch[["doc_id"]][a:b].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def digests(docs: DataFrame, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """`encode_documents` with the ranks of the public tokenizer `name`."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path(name), public_tokenizers.PATTERN)
