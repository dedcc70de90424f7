"""Repair of damaged conversations by the cheapest edits.

The edit lattice has a node for each count of rows read and each state of the role pattern `(s?(ua)+)?`; its edges Keep, Rerole, Delete
and Insert. `cheapest` searches it from both ends: a forward and a reverse heap meet, every crossing of the least cost is finished, and
the least concatenated audit is taken.

Rows are sorted by ranges of (conv_id, turn, role, text, row), so a conversation that holds a third of all rows is split over tasks, and
cut into segments of `SEGMENT` rows. A conversation of one segment is searched as a whole; of more, each segment is searched between all
states, and only these tables meet in one task. The hash of a repaired conversation reads its texts in order (SHA-256 allows nothing
else) as a stream, so a long one costs time there, not memory.

Defined cases: a null role or text, and a null in `conv_id:turn`, is one space; rows without conv_id are one conversation; rows of one
turn are ordered by role, text and a written row number; a role's initial is its first character, and roles with other initials than s,
u, a are never kept; equal rows are duplicates; turn may be null in some rows or all; a conversation without rows after the damage has
zeros; very long texts and conversations pass whole; an empty table gives an empty result; other columns are not read; ids keep their type.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows that one search reads.
SEGMENT = 4096
SPACES = " \t\n\v\f\r"

#: States of the pattern: nothing yet, s, u, a. What follows on a role's initial; the pattern may end in the first and the last.
NOTHING, S, U, A = range(4)
NEXT = {(NOTHING, "s"): S, (NOTHING, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
BEFORE = {(to, x): [q for (q, y), t in NEXT.items() if (t, y) == (to, x)] for to in range(4) for x in "sua"}
FINAL = (NOTHING, A)

#: A row's code: its initial's place in SUA (3 for others), plus 4 times its fault's place in FAULTS.
SUA, FAULTS = "sua", ("none", "blank", "duplicate", "truncated")

Node = tuple[int, int]


def _out(codes: Sequence[int], i: int, q: int) -> Iterator[tuple[Node, int, str]]:
    """Edges from a node: (node, cost, letter)."""
    for x in "ua":
        if (to := NEXT.get((q, x))) is not None:
            yield (i, to), INSERT, "I"
    if i == len(codes):
        return
    yield (i + 1, q), DELETE, "D"
    fault, own = divmod(codes[i], 4)
    if FAULTS[fault] in ("blank", "duplicate"):
        return
    more = TRUNCATED * (FAULTS[fault] == "truncated")
    if own < 3 and (to := NEXT.get((q, SUA[own]))) is not None:
        yield (i + 1, to), KEEP + more, "K"
    for x in "ua":
        if (to := NEXT.get((q, x))) is not None:
            yield (i + 1, to), REROLE + more, "R"


def _into(codes: Sequence[int], i: int, q: int) -> Iterator[tuple[Node, int, str]]:
    """Edges to a node: (node, cost, letter)."""
    for x in "ua":
        for to in BEFORE[q, x]:
            yield (i, to), INSERT, "I"
    if i == 0:
        return
    yield (i - 1, q), DELETE, "D"
    fault, own = divmod(codes[i - 1], 4)
    if FAULTS[fault] in ("blank", "duplicate"):
        return
    more = TRUNCATED * (FAULTS[fault] == "truncated")
    if own < 3:
        for to in BEFORE[q, SUA[own]]:
            yield (i - 1, to), KEEP + more, "K"
    for x in "ua":
        for to in BEFORE[q, x]:
            yield (i - 1, to), REROLE + more, "R"


def cheapest(codes: Sequence[int], start: int = NOTHING, ends: Iterable[int] = FINAL) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from state start to one of ends, the ASCII-least audit of equal ones; None if there is no way.

    Both heaps order nodes of one cost by the rows read, along their own direction. Only Keep can cost nothing, and it reads a row, so a
    node leaves its heap after all that its label of that cost can come from: labels of settled nodes are least. Two ways of one cost to
    one node are never each other's prefix (the longer would insert, at a cost), so least labels stay least when they are extended.
    """
    n = len(codes)
    ahead: dict[Node, tuple[int, str]] = {(0, start): (0, "")}
    back: dict[Node, tuple[int, str]] = {(n, q): (0, "") for q in ends}
    front, rear = [(0, 0, start)], [(0, 0, q) for q in ends]
    heapq.heapify(rear)
    done: tuple[set[Node], set[Node]] = (set(), set())
    best = min((ahead[v][0] + back[v][0] for v in ahead.keys() & back.keys()), default=None)
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        forward = front[0][0] <= rear[0][0]
        cost, read, q = heapq.heappop(front if forward else rear)
        v = (read if forward else n - read, q)
        own, other, seen = (ahead, back, done[0]) if forward else (back, ahead, done[1])
        if v in seen:
            continue
        seen.add(v)
        label = own[v][1]
        for to, more, letter in (_out if forward else _into)(codes, *v):
            said = (cost + more, label + letter if forward else letter + label)
            if to not in own or said < own[to]:
                if to not in own or said[0] < own[to][0]:
                    heapq.heappush(front if forward else rear, (said[0], to[0] if forward else n - to[0], to[1]))
                own[to] = said
                if to in other and (best is None or said[0] + other[to][0] < best):
                    best = said[0] + other[to][0]
    if best is None:
        return None
    met = (ahead[v][1] + back[v][1] for v in [*done[1], *((n, q) for q in ends)] if v in ahead and ahead[v][0] + back[v][0] == best)
    return best, min(met)


def rowwise(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with nulls of role and text as one space."""
    return df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(y) for x, y in ((role, "role"), (text, "text"))])


def damage(rows: DataFrame) -> DataFrame:
    """Rows after the damage that crc32 of `conv_id:turn` says."""
    said = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(said.cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    out = rows.withColumn("_kind", kind).where("_kind <> 0").withColumn("text", text)
    out = out.withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
    return out.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(0), (F.col("_kind") == 3).cast("int"))).alias("_again")).drop("_again")


def _place() -> Column:
    """What orders rows of one role and text: turn (nulls first), then the row number."""
    return F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"), F.col("row").alias("row"))


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, code, seg, at): rows in order, cut into segments; at counts on in a segment. conv_id as text from here on (Python would round long numbers beside nulls). Written."""
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "damaged")
    key = [F.col("conv_id"), F.col("role"), F.sha2("text", 256).alias("_sha")]
    again = rows.groupBy(*key).agg(F.count("*").alias("_n"), F.min(_place()).alias("_first")).where("_n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_sha").alias("_s"), "_first")
    met = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.sha2("text", 256) == F.col("_s")), "left")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(last == "", 1).when(F.coalesce(_place() > F.col("_first"), F.lit(False)), 2).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    initial = F.col("role").substr(1, 1)
    own = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    coded = met.select("conv_id", "turn", "role", "text", "row", (own + 4 * fault).alias("code"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "row"]
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role", "text", "code")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            place = []
            for x in batch["conv_id"].tolist():
                at = at + 1 if last is not None and last[0] == x else 0
                last = (x,)
                place.append(at)
            n = pd.Series(place, index=batch.index)
            yield batch.assign(seg=part * 2**32 + n // SEGMENT, at=n % SEGMENT)

    out = dealt.mapInPandas(cut, "conv_id string, turn string, role string, text string, code int, seg long, at long")
    return materialise(out.withColumn("turn", F.col("turn").cast("long")), "ordered")


def _illegal(initials: Sequence[int]) -> int:
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(initials, initials[1:], strict=False))


def searched(rows: DataFrame) -> DataFrame:
    """(conv_id, seg, segs, first, last, illegal, ways) of each segment: its first and last initial, pairs of neighbours that are illegal in it, the cheapest way from state to state."""
    segments = rows.groupBy("conv_id", "seg").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("codes"))
    count = segments.groupBy(F.col("conv_id").alias("_c")).agg(F.count("*").alias("segs"))
    told = materialise(segments, "segments")
    told = told.join(count.select("_c", "segs").where("segs > 1"), F.col("conv_id").eqNullSafe(F.col("_c")), "left").select("conv_id", "seg", "codes", F.coalesce("segs", F.lit(1)).alias("segs"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, seg, codes, segs in batch.itertuples(index=False, name=None):
                codes = [int(x) for x in codes]
                own = [x % 4 for x in codes]
                tried = [(NOTHING, FINAL)] if segs == 1 else [(a, (b,)) for a in range(4) for b in range(4)]
                ways = [(a, ends[0], *found) for a, ends in tried if (found := cheapest(codes, a, ends)) is not None]
                rows.append((conv, seg, segs, own[0], own[-1], _illegal(own), [dict(zip(("start", "stop", "cost", "audit"), w, strict=True)) for w in ways]))
            yield pd.DataFrame(rows, columns=["conv_id", "seg", "segs", "first", "last", "illegal", "ways"])

    return materialise(told.mapInPandas(search, "conv_id string, seg long, segs long, first int, last int, illegal long, ways array<struct<start:int, stop:int, cost:long, audit:string>>"), "ways")


def solved(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, cost, illegal) of each conversation, and (conv_id, seg, start, audit): the part of its audit that each segment gives, and the state that it begins in."""
    one = ways.where("segs = 1").withColumn("w", F.col("ways")[0])
    single = one.select("conv_id", F.col("seg"), F.lit(NOTHING).alias("start"), F.col("w.audit").alias("audit"), F.col("w.cost").alias("cost"), "illegal")

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("seg")
        labels: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
        trail: list[dict[int, tuple[int, str]]] = []
        illegal, before = 0, None
        for first, last, bad, found in part[["first", "last", "illegal", "ways"]].itertuples(index=False, name=None):
            illegal += int(bad) + (0 if before is None else _illegal([before, first]))
            before = last
            came: dict[int, tuple[int, str]] = {}
            step: dict[int, tuple[int, str]] = {}
            for w in found:
                if w["start"] in labels:
                    cost, audit = labels[w["start"]]
                    said = (cost + w["cost"], audit + w["audit"])
                    if w["stop"] not in came or said < came[w["stop"]]:
                        came[w["stop"]], step[w["stop"]] = said, (w["start"], w["audit"])
            labels = came
            trail.append(step)
        cost, _, at = min((*labels[q], q) for q in FINAL if q in labels)
        pieces = []
        for step in reversed(trail):
            start, audit = step[at]
            pieces.append((start, audit))
            at = start
        pieces.reverse()
        out = part[["conv_id", "seg"]].copy()
        out["start"], out["audit"] = zip(*pieces, strict=True)
        out["cost"], out["illegal"] = [cost] + [0] * (len(out) - 1), [illegal] + [0] * (len(out) - 1)
        return out

    many = ways.where("segs > 1").groupBy("conv_id").applyInPandas(join, "conv_id string, seg long, start int, audit string, cost long, illegal long")
    pieces = materialise(single.unionByName(many), "pieces")
    return pieces.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal")), pieces.select("conv_id", "seg", "start", "audit")


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of each row of the repaired conversations; `place` orders them: seg, and the letter's number in the segment's piece."""
    return _streamed(rows, pieces, texts=True)


def digests(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of each conversation, its rows read in order as a stream."""
    return _streamed(rows, pieces, texts=False)


def _streamed(rows: DataFrame, pieces: DataFrame, texts: bool) -> DataFrame:
    letters = pieces.select("conv_id", "seg", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"), F.col("start").alias("code"))
    both = rows.select("conv_id", "seg", "at", "role", "text", "code").unionByName(letters)
    # Whole conversations are needed for the hash alone; the rows themselves come segment by segment.
    both = both.repartition(*(["conv_id", "seg"] if texts else ["conv_id"])).sortWithinPartitions("conv_id", "seg", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Repair(texts)
        for batch in batches:
            for conv, seg, at, role, text, code in batch[["conv_id", "seg", "at", "role", "text", "code"]].itertuples(index=False, name=None):
                if at < 0:
                    state.turn(conv, seg, text, int(code))
                else:
                    state.read(role, text)
            yield state.take()
        state.end()
        yield state.take()

    return both.mapInPandas(run, "conv_id string, seg long, letter long, role string, text string" if texts else "conv_id string, audit string, repaired_sha256 string")


class _Repair:
    """Follows the letters of a conversation over its rows; holds the audit, never the texts."""

    def __init__(self, texts: bool) -> None:
        self.texts, self.rows = texts, []
        self.conv, self.seg, self.begun = None, 0, False
        self.letters, self.used, self.state = "", 0, NOTHING

    def turn(self, conv, seg: int, letters: str, state: int) -> None:
        """A segment begins."""
        if self.begun and (self.texts or conv != self.conv):
            self.end()
        elif self.begun:
            self._insert()
        if not self.begun:
            self.conv, self.begun, self.audit, self.hash, self.state = conv, True, [], hashlib.sha256(), state
            self.empty = True
        self.seg, self.letters, self.used = seg, letters, 0
        self.audit.append(letters)

    def read(self, role: str, text: str) -> None:
        self._insert()
        letter = self.letters[self.used]
        self.used += 1
        if letter == "K":
            self._say(role, text)
        elif letter == "R":
            self._say(self._due(), text)

    def _due(self) -> str:
        return "assistant" if self.state == U else "user"

    def _insert(self) -> None:
        while self.used < len(self.letters) and self.letters[self.used] == "I":
            self.used += 1
            self._say(self._due(), "")

    def _say(self, role: str, text: str) -> None:
        self.state = NEXT[self.state, role[0]]
        if self.texts:
            self.rows.append((self.conv, self.seg, self.used - 1, role, text))
            return
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def end(self) -> None:
        """The conversation (or, where rows are asked for, the segment) is over."""
        if not self.begun:
            return
        self._insert()
        if not self.texts:
            self.rows.append((self.conv, "".join(self.audit), self.hash.hexdigest()))
        self.begun = False

    def take(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        return pd.DataFrame(rows, columns=["conv_id", "seg", "letter", "role", "text"] if self.texts else ["conv_id", "audit", "repaired_sha256"])


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damaged: bool = True) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation; damaged: damage its rows first."""
    given = rowwise(conversations, conv_id, turn, role, text)
    every = given.select(F.col("conv_id").cast("string").alias("_id")).distinct()
    rows = ordered(damage(given) if damaged else given)
    fault = F.floor(F.col("code") / 4)
    counts = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1).alias("_span"), *[F.count_if(fault == k).alias(x) for k, x in enumerate(FAULTS) if k])
    turns = rows.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("_x")).groupBy("conv_id").agg(F.count("*").alias("_turns"))
    costs, pieces = solved(searched(rows))
    out = every
    for part in (counts, turns, costs, digests(rows, pieces)):
        out = out.join(part, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        F.col("_id").cast(given.schema["conv_id"].dataType).alias("conv_id"),
        zero(F.col("_span") - F.col("_turns")).alias("gaps"),
        *[zero(F.col(c)).alias(c) for c in (*FAULTS[1:], "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def repaired_rows(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damaged: bool = False) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations themselves. position counts from 0 in ordered steps with gaps where rows went."""
    given = rowwise(conversations, conv_id, turn, role, text)
    rows = ordered(damage(given) if damaged else given)
    _, pieces = solved(searched(rows))
    size = pieces.select("conv_id", "seg", F.length("audit").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    size = size.select(F.col("conv_id").alias("_c"), F.col("seg").alias("_s"), "_before")
    got = repaired(rows, pieces).join(size, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("seg") == F.col("_s")))
    return got.select(F.col("conv_id").cast(given.schema["conv_id"].dataType).alias("conv_id"), (F.col("_before") + F.col("letter")).alias("position"), "role", "text")
