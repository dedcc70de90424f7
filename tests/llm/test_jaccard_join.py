"""The n-gram Jaccard join: signatures against all pairs of sets, the join against brute force over odd tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidewatch.llm import jaccard_join as J
from tidewatch.llm import near_dedup

ROWS = "doc_id {}, text string, lang string, n_shingles string, component_id int, key double, node string"


def sets_of(texts, width=4):
    out = []
    for x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def by_hand(ids, texts):
    """{(doc_id, text): (n_shingles, component_id)} from all pairs."""
    sets = sets_of(texts)
    comp = list(range(len(texts)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if sets[i] and x is not None:
            least[root(i)] = min(least.get(root(i), x), x)
    return [(ids[i], len(sets[i]), (least.get(root(i)) if sets[i] else ids[i])) for i in range(len(texts))]


def near_pair(rng, size):
    """Two sets of hashes about as different as a linked pair may be."""
    every = rng.integers(0, 2**64, 2 * size + 40, dtype=np.uint64)
    other = max(1, min(int(size / 0.85), size + int(rng.integers(0, size // 5 + 2))))
    most = J.differing(size, other) if rng.random() < 0.8 else int(rng.integers(0, J.differing(size, other) + 1))
    common = (size + other - most + 1) // 2
    if common > min(size, other):
        common = min(size, other)
    a, b = every[:size], np.concatenate([every[:common], every[size : size + other - common]])
    return np.unique(near_dedup._mix(a)), np.unique(near_dedup._mix(b))


@pytest.mark.parametrize("size", [1, 4, 5, 6, 7, 9, 10, 11, 15, 20, 21, 33, 40, 41, 70, 80, 81, 150, 320, 321, 900, 2600])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(150 if size < 500 else 20):
        a, b = near_pair(rng, size)
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both) or (len(a) == len(b) == both):
            continue
        (x, n), (y, m) = J.signatures_of(a), J.signatures_of(b)
        met = set(x.tolist()) & set(y.tolist())
        assert met and met & (set(x[:n].tolist()) | set(y[:m].tolist()))


def test_schemes_leave_a_shared_signature_and_enumerate_subsets():
    for band in range(1, 18):
        s = J.scheme(band)
        top = J.FIRST_BAND * 2**band
        assert s.shared(J.differing(top, top)) >= 1 and s.taken < s.cells
        assert [s.shared(d) for d in range(5)] == sorted((s.shared(d) for d in range(5)), reverse=True)
        assert len(J._subsets(s)) == s.signatures
        assert J.band_of(top) == band and J.band_of(top + 1) == band + 1


def test_shared_is_the_worst_case():
    """All ways to spoil cells of a small scheme."""
    from itertools import product

    s = J.Scheme(1, 2, 3, 2)
    for differ in range(5):
        worst = s.signatures
        for spots in product(range(6), repeat=differ):
            spoilt = set(spots)
            worst = min(worst, sum(not spoilt & set(x) for x in J._subsets(s).tolist()))
        assert s.shared(differ) == worst


def texts_of(seed):
    rng = random.Random(seed)
    out = [None, "", " \n ", "one", "ONE", "two words", "three little words", "same text here for all", "Same text here for all", "w " * 5000]
    for size in (6, 9, 13, 24, 43, 90, 200, 400):
        for _ in range(3):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, size // 40, size // 25, size // 25, size // 12):
                now = list(base)
                for _ in range(edits):
                    at = rng.randrange(len(now))
                    now[at : at + 1] = rng.choice([[], ["new", "words"], [f"x{rng.randrange(99)}"]])
                out.append(" ".join(now))
    passage = " ".join(f"p{i}" for i in range(60))
    out += [f"{passage} {' '.join(f'q{rng.randrange(9999)}' for _ in range(rng.choice([0, 5, 9, 11, 100])))}" for _ in range(40)]
    return out


@pytest.mark.parametrize(("seed", "kind"), [(1, "long"), (2, "string")])
def test_join_matches_all_pairs(spark, seed, kind):
    texts = texts_of(seed)
    rng = random.Random(seed)
    ids = [rng.choice([None, i, i, i, i, 7]) for i in range(len(texts))]
    ids = [None if x is None else f"d{x:04d}" if kind == "string" else x for x in ids]
    df = spark.createDataFrame([(i, x, "en", "clash", 1, 0.5, "n") for i, x in zip(ids, texts, strict=True)], ROWS.format(kind))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(df).collect()), key=key) == sorted(by_hand(ids, texts), key=key)


def test_bucket_of_many_components(spark):
    """Members of one bucket that are in no one's component are still compared with each other and with the largest one."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for k in range(30):  # chains: each step is near the last one, ends are far apart
        now = list(base)
        for step in range(4):
            now[(7 * k + 13 * step) % 110] = f"c{k}s{step}"
            now[(11 * k + 29 * step) % 110] = f"d{k}s{rng.randrange(9)}"
            texts.append(" ".join(now))
    df = spark.createDataFrame([(i, x, "", "", 0, 0.0, "") for i, x in enumerate(texts)], ROWS.format("long"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(df).collect()) == sorted(by_hand(range(len(texts)), texts))


def test_heads_of_three_meet_in_all_pairs(spark):
    """Both heads of a bucket of three were often one member, and nothing compared the other two afterwards."""
    members = spark.createDataFrame([(k, 3 * k + i, 3) for k in range(200) for i in range(3)], "key long, node long, n long")
    assert {(r.a, r.b) for r in near_dedup.head_pairs(members).collect()} == {(3 * k + i, 3 * k + j) for k in range(200) for i, j in ((0, 1), (0, 2), (1, 2))}


def test_no_link_is_lost_in_buckets_of_three(spark):
    """of three texts that share a single signature two are linked and the third, near neither, may be both heads."""
    rng = random.Random(13)

    def shingles(words):
        return set(next(near_dedup.shingle_sets([" ".join(words)], 4)).tolist())

    texts = []
    while len(texts) < 3 * 60:
        base = [f"w{rng.randrange(10**6)}" for _ in range(11)]
        a, b = [*base, f"x{rng.randrange(10**6)}", f"x{rng.randrange(10**6)}"], [*base, f"y{rng.randrange(10**6)}"]
        spoilt = {h * 3 >> 64 for h in (shingles(a) | shingles(b)) - shingles(base)}
        if len(spoilt) == 1:  # all that differs lies in one cell of three, so one signature of two cells is left to all
            texts += [" ".join(base), " ".join(a), " ".join(b)]
    df = spark.createDataFrame([(i, x, "", "", 0, 0.0, "") for i, x in enumerate(texts)], ROWS.format("long"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(df).collect()) == sorted(by_hand(range(len(texts)), texts))


def test_empty_table(spark):
    assert J.joined(spark.createDataFrame([(1, "a b c d e", "", "", 0, 0.0, "")], ROWS.format("long")).limit(0)).count() == 0
