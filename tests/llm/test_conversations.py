"""Conversation repair against a slow twin: every row in plain Python, the edits by a table over all nodes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tidewatch.llm import conversations as C

ROWS = "conv_id long, turn long, role string, text string, cost string, seg int"


def by_table(codes, start=C.NOTHING, ends=C.FINAL):
    """The least (cost, audit) by going over the rows once, all states at a time."""

    def inserts(labels):
        for _ in range(4):
            for q, (cost, audit) in list(labels.items()):
                for x in "ua":
                    to, said = C.NEXT.get((q, x)), (cost + 5, audit + "I")
                    if to is not None:
                        labels[to] = min(labels.get(to, said), said)
        return labels

    labels = inserts({start: (0, "")})
    for code in codes:
        fault, own = divmod(code, 4)
        after = {}
        for q, (cost, audit) in labels.items():
            steps = [(q, 2, "D")]
            if fault not in (1, 2):
                more = 5 * (fault == 3)
                steps += [(C.NEXT.get((q, "suax"[own])), more, "K"), *[(C.NEXT.get((q, x)), 1 + more, "R") for x in "ua"]]
            for to, more, letter in steps:
                if to is not None:
                    said = (cost + more, audit + letter)
                    after[to] = min(after.get(to, said), said)
        labels = inserts(after)
    return min((labels[q] for q in ends if q in labels), default=None)


def by_hand(rows, damaged=True):
    """{conv_id: all columns} of the contract."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for c, t, role, text in (r[:4] for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damaged else 9
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes = set(), []
        for _, role, text in own:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append(max("sua".find(role[:1]) if role else -1, -1) % 4 + 4 * fault)
        cost, audit = by_table(codes)
        state, said, k = C.NOTHING, [], 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else own[k][1:]
            k += letter != "I"
            if letter == "D":
                continue
            role = role if letter == "K" else "assistant" if state == C.U else "user"
            state = C.NEXT[state, role[0]]
            said.append(f"{role}:{text}")
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[1][:1] for r in own]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": sum(c // 4 == 1 for c in codes), "duplicate": sum(c // 4 == 2 for c in codes), "truncated": sum(c // 4 == 3 for c in codes),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest(),
        }
    return out


def odd_rows():
    rng = random.Random(7)
    texts = ["Hi.", "no end", "", " \n", None, "Why?", "x" * 30_000 + "!", "same.", "same.", "é\x85", "ü?\n"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 2**62 + 1]), rng.choice([None, 0, 1, 2, 3, 7, 9, 2**60]), rng.choice(["system", "user", "user", "assistant", "assistant", None, "tool", "", "User"]), rng.choice(texts), "clash", 3) for _ in range(140)]
    lost = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, (lost, 0, "user", "all rows of it go.", "clash", 3)]


def test_search_finds_the_least_audit():
    rng = random.Random(3)
    for _ in range(1500):
        codes = [rng.randrange(4) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randrange(12))]
        for start in range(4):
            for ends in (C.FINAL, (0,), (1,), (2,), (3,)):
                assert C.cheapest(codes, start, ends) == by_table(codes, start, ends)


@pytest.mark.parametrize("segment", [4096, 3])
def test_repair_matches_plain_python(spark, monkeypatch, segment):
    """Segments of three rows are joined again; nulls in all columns, ties, repeats, long texts, clashing columns."""
    monkeypatch.setattr(C, "SEGMENT", segment)
    rows = odd_rows()
    got = {r.conv_id: r.asDict() for r in C.repair(spark.createDataFrame(rows, ROWS)).collect()}
    assert {k: {x: v[x] for x in v if x != "conv_id"} for k, v in got.items()} == by_hand(rows)


def test_long_conversation_is_split(spark):
    rng = random.Random(5)
    rows = [(8, i, rng.choice(["user", "assistant"]), rng.choice([f"text {i}.", "no end", "again.", ""]), "", 0) for i in range(9000)] + [(9, 0, "system", "Alone.", "", 0)]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    ordered = C.ordered(C.rowwise(df))
    assert ordered.where("conv_id = 8").select("seg").distinct().count() >= 3
    got = {r.conv_id: r.asDict() for r in C.repair(df, damaged=False).collect()}
    want = by_hand(rows, damaged=False)
    assert all(got[k][x] == want[k][x] for k in want for x in want[k])
    assert got[9]["audit"] == "D" and got[9]["cost"] == 2


def test_repaired_rows_are_legal(spark):
    got = C.repaired_rows(spark.createDataFrame(odd_rows(), ROWS), damaged=True).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.position):
        by.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = by_hand(odd_rows())
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in by.items()} == {k: v["repaired_sha256"] for k, v in want.items() if set(v["audit"]) - {"D"}}


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), (None, 0, "user", "Lost.")], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in C.repair(df, damaged=False).collect()}
    assert got["a"].audit == "KK" and got[None].audit == "D"
    empty = C.repair(df.limit(0))
    assert empty.count() == 0 and empty.schema["conv_id"].dataType.simpleString() == "string"


def test_query_matches_plain_python(spark):
    from tidewatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, sf).collect()}
    assert {k: {x: v[x] for x in v if x != "conv_id"} for k, v in got.items()} == by_hand(rows)
