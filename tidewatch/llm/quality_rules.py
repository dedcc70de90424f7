"""Quality rules as a short-circuit cascade, with built-in functions only.

Every rule names the measures that it reads. A sample (rows by hashes of their texts, so the same at every run) gives
each rule's cost (what its measures scan: characters, words, lines) and selectivity (share of rows rejected); rules run in the order
of rejection per cost, and a row that one rule rejects is not measured for the next. The order changes cost, never the verdict, which
is the conjunction of all rules. `judge` returns five measures for all rows by contract, so only further measures are skipped there;
`cascade_filter` skips all.

Defined cases: a null text has no words; so has an empty one, and both fail the word-count rule. Repeated rows are judged one by
one. An empty table gives an empty result. Extra columns pass through `cascade_filter`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"

#: Limits of the rules, in per cent or as they say.
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT = 8, 30
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 20
MIN_LETTER_WORD_PCT, MAX_ELLIPSIS_PCT, MAX_BULLET_PCT = 50, 30, 90


def _m(name: str) -> Column:
    return F.col(f"_m_{name}")


def _window_hashes() -> Column:
    h = _m("hashes")
    at = lambda i, k: F.get(h, i + k)
    return F.when(
        F.size(h) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))


def _repeat_positions() -> Column:
    """Starts of the windows whose hash some other window has: neighbours in the sorted (hash, start) list."""
    s = _m("sorted")
    same = lambda k, d: F.coalesce(F.get(s, k + d)["h"] == F.get(s, k)["h"], F.lit(False))
    return F.array_sort(F.filter(F.transform(s, lambda x, k: F.when(same(k, F.lit(-1)) | same(k, F.lit(1)), x["i"])), lambda i: i.isNotNull()))


def _covered() -> Column:
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"))
    return F.aggregate(_m("starts"), start, step, lambda a: a["n"].cast("long"))


#: Measure -> (measures it needs first, its expression).
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "words": (("text",), lambda: words_of(_m("text"))),
    "n_words": (("words",), lambda: F.size(_m("words")).cast("long")),
    "joined": (("words",), lambda: F.array_join(_m("words"), "")),
    "word_chars": (("joined",), lambda: F.length(_m("joined")).cast("long")),
    "n_symbols": (("joined",), lambda: (F.length(_m("joined")) - F.length(F.regexp_replace(_m("joined"), SYMBOLS, ""))).cast("long")),
    "lines": (("text",), lambda: F.filter(F.split(_m("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))),
    "n_lines": (("lines",), lambda: F.size(_m("lines")).cast("long")),
    "n_dup_lines": (("lines",), lambda: (F.size(_m("lines")) - F.size(F.array_distinct(_m("lines")))).cast("long")),
    "hashes": (("words",), lambda: F.transform(_m("words"), lambda w: F.xxhash64(w))),
    "windows": (("hashes",), _window_hashes),
    # Only texts that repeat a window are sorted.
    "sorted": (("windows",), lambda: F.when(F.size(F.array_distinct(_m("windows"))) < F.size(_m("windows")), F.array_sort(F.transform(_m("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))),
    "starts": (("sorted",), lambda: F.coalesce(_repeat_positions(), F.array().cast("array<int>"))),
    "n_repeat_words": (("starts",), _covered),
    "n_letter_words": (("words",), lambda: F.size(F.filter(_m("words"), lambda w: w.rlike(r"\p{L}"))).cast("long")),
    "n_ellipsis_lines": (("lines",), lambda: F.size(F.filter(_m("lines"), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*\z"))).cast("long")),
    "n_bullet_lines": (("lines",), lambda: F.size(F.filter(_m("lines"), lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long")),
}
#: Measures that `judge` returns, for all rows.
RETURNED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _work(name: str) -> Column:
    """What a measure scans in a row, in characters; a word's hash or pattern counts as 8, a line's as 16."""
    text, words = F.length("text"), 8 * F.size(words_of(F.col("text")))
    if name in ("words", "joined", "lines", "n_symbols"):
        return text
    if name in ("hashes", "windows", "n_letter_words"):
        return words
    if name in ("n_dup_lines", "n_ellipsis_lines", "n_bullet_lines"):
        return 16 * F.size(F.split("text", "\n"))
    return F.lit(1)


@dataclass(frozen=True)
class Rule:
    """rejects: condition over measures; base: one of the two rules that hold by contract."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[], Column]
    base: bool = False
    cost: float = 1.0
    rejection: float = 0.0


RULES = (
    Rule("few_words", ("n_words",), lambda: _m("n_words") < MIN_WORDS, base=True),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), lambda: 100 * _m("n_repeat_words") > MAX_REPEAT_PCT * _m("n_words"), base=True),
    Rule("symbols", ("word_chars", "n_symbols"), lambda: 100 * _m("n_symbols") > MAX_SYMBOL_PCT * _m("word_chars")),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda: 100 * _m("n_dup_lines") > MAX_DUP_LINE_PCT * _m("n_lines")),
    Rule("few_letters", ("n_words", "n_letter_words"), lambda: 100 * _m("n_letter_words") < MIN_LETTER_WORD_PCT * _m("n_words")),
    Rule("ellipses", ("n_lines", "n_ellipsis_lines"), lambda: 100 * _m("n_ellipsis_lines") > MAX_ELLIPSIS_PCT * _m("n_lines")),
    Rule("bullets", ("n_lines", "n_bullet_lines"), lambda: 100 * _m("n_bullet_lines") > MAX_BULLET_PCT * _m("n_lines")),
    Rule("word_length", ("n_words", "word_chars"), lambda: (_m("word_chars") < MIN_MEAN_WORD * _m("n_words")) | (_m("word_chars") > MAX_MEAN_WORD * _m("n_words"))),
)


def closure(names: tuple[str, ...]) -> list[str]:
    """names and all measures that they need, each after what it needs."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out or name == "text":
            return
        for need in MEASURES[name][0]:
            visit(need)
        out.append(name)

    for name in names:
        visit(name)
    return out


def with_measures(df: DataFrame, names: tuple[str, ...], text: str = "text", only: Column | None = None) -> DataFrame:
    """df with each `_m_` measure that names need and df lacks, null in rows where `only` is false; one projection a level, so that none is computed twice."""
    if "_m_text" not in df.columns:
        df = df.withColumn("_m_text", F.coalesce(df[text].cast("string"), F.lit("")))
    todo = [n for n in closure(names) if f"_m_{n}" not in df.columns]
    while todo:
        done = {c[3:] for c in df.columns if c.startswith("_m_")}
        now = [n for n in todo if set(MEASURES[n][0]) <= done]
        df = df.withColumns({f"_m_{n}": MEASURES[n][1]() if only is None else F.when(only, MEASURES[n][1]()) for n in now})
        todo = [n for n in todo if n not in now]
    return df


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 400, given: tuple[str, ...] = ()) -> list[Rule]:
    """Rules by rejection per cost, both estimated on at most sample_rows texts, the least by hash of a hashed share. The bound holds for this estimate alone.

    given: measures that are there in any case; they and what they need cost a rule nothing.
    """
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # A share of the hashes that holds about 8 times the sample, so that the partitions don't send a sample each.
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, 8 * sample_rows / max(1, docs.count()))))
    # Written before it is measured: measures pushed below the limit would turn the top-k into a sort of the whole table.
    sample = materialise(texts.where(share).orderBy(F.xxhash64("text"), "text").limit(sample_rows), "cascade-sample")
    free = set(closure(given))
    cost = [sum((_work(n) for n in closure(r.needs) if n not in free), F.lit(1)) for r in rules]
    df = with_measures(sample.withColumns({f"_cost{i}": c for i, c in enumerate(cost)}), tuple(n for r in rules for n in r.needs))
    got = df.agg(*[F.avg(f"_cost{i}").alias(f"c{i}") for i in range(len(rules))], *[F.avg(r.rejects().cast("int")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    seen = [replace(r, cost=float(got[f"c{i}"] or 1), rejection=float(got[f"r{i}"] or 0)) for i, r in enumerate(rules)]
    return sorted(seen, key=lambda r: (-r.rejection / r.cost, r.cost, r.name))


def cascade_filter(docs: DataFrame, order: list[Rule], text: str = "text") -> DataFrame:
    """Rows of docs that no rule rejects; the measures of a rule are computed for the survivors of those before it."""
    df = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))  # no column of docs can clash
    for rule in order:
        # The running number keeps the condition above the measures: pushed below, it would compute them anew inside its lambdas.
        df = with_measures(df, rule.needs).withColumn("_at", F.monotonically_increasing_id())
        df = df.where(~F.coalesce(rule.rejects(), F.lit(False)) & (F.col("_at") >= 0)).drop("_at")
    return df.select("row.*")


def judge(docs: DataFrame, order: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: measures, base_failed, kept and rejected_by, the first rule of the cascade that rejects it (null: none)."""
    base = [r for r in order if r.base]
    df = with_measures(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), (*RETURNED, *(n for r in base for n in r.needs)))
    df = df.withColumns({"base_failed": reduce(Column.__or__, [r.rejects() for r in base], F.lit(False)), "_by": F.lit(None).cast("string")})
    for rule in order:
        df = with_measures(df, rule.needs, only=F.col("_by").isNull())
        df = df.withColumn("_by", F.coalesce("_by", F.when(rule.rejects(), F.lit(rule.name))))
    return df.select("doc_id", *[_m(c).alias(c) for c in RETURNED], "base_failed", F.col("_by").isNull().alias("kept"), F.col("_by").alias("rejected_by"))


def verdicts(docs: DataFrame) -> DataFrame:
    """`judge` with the default rules in the order that a sample of docs gives."""
    return judge(docs, plan_cascade(docs, given=RETURNED))


def keep_good(docs: DataFrame) -> DataFrame:
    """`cascade_filter` with the default rules in the order that a sample of docs gives."""
    return cascade_filter(docs, plan_cascade(docs))
