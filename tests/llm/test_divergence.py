"""Source divergence against plain integers, and its block products against all pairs of terms."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidewatch.llm import divergence as D

ROWS = "doc_id long, text string, lang string, source string, item int, value double, part string, term string"


def by_hand(rows, least_docs, most_rank=50):
    docs = [(x or "", a or "", b or "") for _, x, a, b, *_ in rows]
    found = [([re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x)], a, b) for x, a, b in docs]
    out = set()
    for lang in {a for _, a, _ in found}:
        df = Counter(w for ws, a, _ in found if a == lang for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= least_docs)
        counts = {b: Counter() for _, a, b in found if a == lang}
        for ws, a, b in found:
            if a == lang:
                counts[b].update(w for w in ws if w in set(kept))
        total = sum(counts.values(), Counter())

        def price(n, all_n):
            return 1 + Fraction(10**9 * (n + 5), all_n + 5 * len(kept)).__floor__()  # noqa: B023

        p = {b: {w: price(c[w], c.total()) for w in kept} for b, c in counts.items()}
        q = {w: price(total[w], total.total()) for w in kept}
        for b in counts:
            pairs = sorted(((-sum(abs(p[b][w] - p[o][w]) for w in kept), o.encode(), o) for o in counts if o != b))
            out |= {(lang, b, "pair", o, -v, k) for k, (v, _, o) in enumerate(pairs, 1)}
            terms = sorted((q[w] - p[b][w], w.encode(), w) for w in kept if counts[b][w] and p[b][w] > q[w])
            out |= {(lang, b, "term", w, -v, k) for k, (v, _, w) in enumerate(terms, 1) if k <= most_rank}
    return out


def odd_rows():
    rng = random.Random(11)
    words = ["Alpha", "alpha", "beta-gamma", "É", "é", "x1y", "日本", "\xa0", "delta_", "@", "KK", "zeta", "eta", "theta"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(40))) if rng.random() > 0.1 else None, rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "s2", "S2", "é", None]), 1, 0.5, "clash", "t") for i in range(300)]
    rows += [(900, "alpha " * 100_000, "en", "s1", 1, 0.5, "", ""), (901, "12 34", "en", "empty", 1, 0.5, "", ""), (902, "lonely words", "xx", "a", 1, 0.5, "", ""), (903, "", "xx", "b", 1, 0.5, "", "")]
    return rows + rows[:20]


@pytest.mark.parametrize(("terms", "groups", "held"), [(2048, 64, 400_000), (3, 2, 5)])
def test_audit_matches_plain_integers(spark, monkeypatch, terms, groups, held):
    """Nulls, equal rows, a very long text, a group and a language without kept terms, ties, clashing columns; small blocks give the same."""
    for name, x in (("TERMS", terms), ("GROUPS", groups), ("HELD", held)):
        monkeypatch.setattr(D, name, x)
    rows = odd_rows()
    got = D.audit(spark.createDataFrame(rows, ROWS), least_docs=12).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == by_hand(rows, 12)


def test_block_product_is_all_pairs_of_terms():
    rng = np.random.default_rng(2)
    left, right = rng.geometric(0.3, (500, 4)) - 1, rng.geometric(0.1, (500, 3)) - 1
    n, m = left.sum(axis=0).tolist(), right.sum(axis=0).tolist()
    price = lambda c, all_n: np.array([1 + 10**9 * (int(x) + 5) // (all_n + 5 * 700) for x in c])
    want = [[int(np.abs(price(left[:, i], n[i]) - price(right[:, j], m[j])).sum()) for j in range(3)] for i in range(4)]
    assert D.block_product(left, right, n, m, 700, False).tolist() == want


def test_joint_table_is_the_product_of_indicator_columns():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, (200, 3))
    coded = [D.levels(counts[:, g]) for g in range(3)]
    starts = np.cumsum([0, *[len(x) for x, _ in coded]])
    place = np.stack([own + starts[g] for g, (_, own) in enumerate(coded)], axis=1)
    hot = np.zeros((200, starts[-1]), np.int64)
    for g in range(3):
        hot[np.arange(200), place[:, g]] = 1
    full = hot.T @ hot
    for g in range(3):
        table = np.zeros_like(full)
        a, b, n = D.joint(place[:, g], place, starts[-1])
        table[a, b] = n
        assert (table[starts[g] : starts[g + 1]] == full[starts[g] : starts[g + 1]]).all()


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame(odd_rows(), ROWS).limit(0)).collect() == []
