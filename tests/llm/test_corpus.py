"""The corpus operators against brute force, libraries and planted cases, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import bpe, classifier, fingerprints, html_text, license_scan, near_dedup, packing, quality_rules, sharding, warc_fixity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, score double, bucket int, key string, _m_words int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
BASE = " ".join(f"word{i}" for i in range(200))
TEXTS = [None, "", " \n\t ", "one", "Two words", "same text here for all of us", "same text here for all of us", LONG, BASE, BASE + " tail", BASE.upper(), "a b c d e f g h i j k l", "é  ü\xa0ß 日本 \x1c! <|endoftext|> 's", "x" * 5000, "la la la la la la la la la la la la"]


def table(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "clash", 0.5, 1, "k", 7) for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, TEXTS)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_rules(spark, docs):
    got = rows(quality_rules.verdicts(docs))
    for i, t in enumerate(TEXTS):
        w = words(t)
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(windows)
        covered = {j for k, x in enumerate(windows) if n[x] > 1 for j in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.kept and r.base_failed)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    order = quality_rules.plan_cascade(docs)
    assert sorted(r.name for r in order) == sorted(r.name for r in quality_rules.RULES)


def test_quality_rules_skip_measures(spark, docs, monkeypatch):
    """A measure whose evaluation fails on short texts is never reached for them behind the word-count rule, and is before it."""
    from pyspark.sql import functions as F

    fails = lambda: F.when(F.size("_m_words") < 10, F.raise_error(F.lit("measured"))).otherwise(F.lit(0)).cast("long")
    monkeypatch.setitem(quality_rules.MEASURES, "fails", (("words",), fails))
    few = next(r for r in quality_rules.RULES if r.name == "few_words")
    late = quality_rules.Rule("late", ("fails",), lambda: F.col("_m_fails") > 0)
    got = rows(quality_rules.judge(docs, [few, late]))
    assert {i for i, r in got.items() if r.kept} == {i for i, t in enumerate(TEXTS) if len(words(t)) >= 10}
    assert {r.rejected_by for r in got.values()} == {None, "few_words"}
    assert quality_rules.cascade_filter(docs, [few, late]).count() == sum(len(words(t)) >= 10 for t in TEXTS)
    with pytest.raises(Exception, match="measured"):
        quality_rules.judge(docs, [late, few]).collect()


def test_quality_rules_order_is_stable(spark):
    junk = ["a b c"] * 30 + ["... \n".join(f"line{i} of{i} this{i} text{i}" for i in range(20)) + "..."] * 60 + [f"plain words of text number {i} stand here for all to read" for i in range(60)]
    df = table(spark, junk)
    orders = [[(r.name, r.cost, r.rejection) for r in quality_rules.plan_cascade(d, sample_rows=100)] for d in (df, df.repartition(7), df.orderBy("doc_id", ascending=False))]
    assert orders[0] == orders[1] == orders[2] and [n for n, *_ in orders[0]].index("ellipses") < [n for n, *_ in orders[0]].index("symbols")
    got = Counter(r.rejected_by for r in quality_rules.verdicts(df).collect())
    assert got["ellipses"] == 60 and got[None] == 60


def test_quality_rules_reject_junk(spark):
    clean = " ".join(f"plain{i} sentence{i}" for i in range(50))
    junk = [" ".join(f"w{i}*** x{i}%%%" for i in range(40)), "\n".join(["the same line again now"] * 9 + [BASE]), " ".join("ab" * 30 for _ in range(20))]
    got = rows(quality_rules.verdicts(table(spark, [clean, *junk])))
    assert [got[i].kept for i in range(4)] == [True, False, False, False]


def test_byte_bpe(spark, docs):
    tiktoken, tok = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = tok.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    got = rows(bpe.encode_documents(docs, path, tok.PATTERN, keep_ids=True))
    for i, t in enumerate(TEXTS):
        ids = own.encode_ordinary(t or "")
        r = got[i]
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(r.decoded) == (t or "").encode() and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_byte_bpe_long_words(spark, monkeypatch):
    """Words of many units, of one letter, of glued tokens, in parts of a long text, with few steps a recursion and small memory."""
    tiktoken, tok = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = tok.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    own = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(8)
    letters = [t.decode() for t in ranks if t.isalpha() and t.isascii()]
    texts = [" ".join("".join(rng.choice(list("acgt"), 1900)) for _ in range(20)), "".join(rng.choice(list("acgt"), 10_000)), "a" * 3000, *("".join(rng.choice(letters, 200)) for _ in range(20)), "".join(rng.choice(list("日本語中文字"), 700))]
    check = lambda e, ts: [([int(i) for i in ids.split(",")], raw.decode()) for ids, raw in e.encode(ts)] == [(own.encode_ordinary(t), t) for t in ts]
    e = bpe.Encoder(path, tok.PATTERN)
    assert check(e, texts)
    assert e.decode([own.encode_ordinary(texts[0]), [0]]) == [texts[0].encode(), bytes([next(k for k, v in ranks.items() if v == 0)[0]])]
    monkeypatch.setattr(bpe, "STEPS", 3)
    monkeypatch.setattr(bpe, "ROUND", 500)
    small = bpe.Encoder(path, tok.PATTERN, memory=1000)
    for _ in range(3):
        assert check(small, texts[3:10])
    parts = list(bpe.sections(texts[0] + "  x \n y", 2000))
    assert len(parts) > 5 and "".join(parts) == texts[0] + "  x \n y"
    assert sum((own.encode_ordinary(x) for x in parts), []) == own.encode_ordinary("".join(parts))


def test_sharding(spark, docs):
    found = sharding.assign(table(spark, [f"text {i}" for i in range(4000)])).collect()
    assert {r.shard for r in found} == set(range(16))
    for s in range(16):
        own = sorted(r.slot for r in found if r.shard == s)
        assert own == list(range(len(own))) and 150 < len(own) < 350
    assert all(r.grown_shard in (r.shard, 16) for r in found) and any(r.grown_shard == 16 for r in found)
    got = rows(sharding.assign(docs))
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law) == (len(raw) + 1, zlib.crc32(raw), "key")
    tree = {"a": {"x": {0: 1, 1: 1}}, "b": {"y": {2: 1, 3: 1}}}
    heavier = {"a": {"x": {0: 1, 1: 1}}, "b": {"y": {2: 1, 3: 3}}}
    before, after = ({r.doc_id: r.shard for r in sharding.assign(table(spark, ["t"] * 2000), t).collect()} for t in (tree, heavier))
    assert all(after[i] in (2, 3) for i in before if after[i] != before[i])


def test_sharding_draws(spark):
    """Shards and the shards of a grown tree by brute force over the draws."""
    import math

    def choose(doc, weights):
        u = lambda p: (int(hashlib.md5(f"{doc}:{p}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return min(range(len(weights)), key=lambda i: (-math.log(u(weights[i][0])) / weights[i][1], i)) if len(weights) > 1 else 0

    def shard(doc, tree):
        g = list(tree)[choose(doc, [(g, sum(w for r in racks.values() for w in r.values())) for g, racks in tree.items()])]
        k = list(tree[g])[choose(doc, [(f"{g}/{k}", sum(r.values())) for k, r in tree[g].items()])]
        return list(tree[g][k])[choose(doc, [(f"{g}/{k}/{s}", w) for s, w in tree[g][k].items()])]

    tree = sharding.default_tree()
    got = rows(sharding.assign(table(spark, ["t"] * 400)))
    assert all((got[i].shard, got[i].grown_shard) == (shard(i, tree), shard(i, sharding.grown(tree))) for i in range(400))
    same = sharding.assign(table(spark, ["t"] * 300, [7] * 300)).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == list(range(300))


def test_packing(spark, docs):
    tokenizers, tok = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = tok.path("byte_bpe_50k.json")
    own = tokenizers.Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, tok.PATTERN, per_group=4).collect()
    for i, t in enumerate(TEXTS):
        ids, at = [*own.encode(t or "", add_special_tokens=False).ids, 2], 0
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine))) and all(r.length == 1024 for r in mine[1:])
        for r in mine:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    fill = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024


def test_packing_bound():
    rng = np.random.default_rng(1)
    for n in (1, 7, 400):
        sizes = rng.integers(1, 1024, n)
        at, offset, fill = packing.best_fit(sizes, 1024)
        assert fill.max() <= 1024 and packing.lower_bound(sizes, 1024) <= len(fill) <= packing.lower_bound(sizes, 1024) * 1.05 + 1
        assert all(fill[b] == sizes[at == b].sum() for b in range(len(fill)))
    assert packing.lower_bound(np.array([600] * 10), 1024) == 10 == len(packing.best_fit(np.array([600] * 10), 1024)[2])


def test_packing_places_all(spark, monkeypatch):
    items = spark.range(20_000).selectExpr("id AS uid", "400L AS length")
    got = packing.pack(items).collect()
    assert sorted(r.uid for r in got) == list(range(20_000)) and len({r.sequence_id for r in got}) == 10_000
    rng = np.random.default_rng(2)
    sizes = [400 if i % 3 == 0 else int(rng.integers(342, 1024)) for i in range(900)]
    assert packing.lower_bound(np.array([400] * 8_000), 1024) == 4_000
    monkeypatch.setattr(packing, "lower_bound", lambda *_: 0)  # nothing is ever certified
    got = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "uid long, length long"), per_group=100).collect()
    fill = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += sizes[r.uid]
    assert sorted(r.uid for r in got) == list(range(900)) and max(fill.values()) <= 1024


def brute_components(texts, num=85, den=100):
    sets = []
    for t in texts:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and den * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def edits(seed=5):
    """Chains and stars of near copies around the threshold, and large groups of copies."""
    rng = np.random.default_rng(seed)
    out = list(TEXTS)
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(30, 250)))]
        for _ in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(10**9)}"
            out.append(" ".join(w))
            if rng.random() < 0.5:
                base = w
    return out + [BASE] * 40 + ["the hot line of all is here " + f"own{i} text{i} and{i} more{i} of{i} it{i}" for i in range(40)]


def test_near_dedup_exact_filter(spark):
    """Every link between different texts is among the pairs of the exact filter, though members of the main component never meet."""
    texts = sorted(set(t for t in edits() if words(t)))
    sets = [next(near_dedup.shingle_sets([t])) for t in texts]
    comp = [0 if i % 3 == 0 else i for i in range(len(texts))]
    marks = [tuple(near_dedup.odd_sketch(near_dedup.samples_of(x)).tolist()) for x in sets]
    schema = "node long, comp long, mark struct<s0: long, s1: long, s2: long, s3: long>, set array<long>"
    df = spark.createDataFrame([(i, comp[i], marks[i], x.view(np.int64).tolist()) for i, x in enumerate(sets)], schema)
    rare = near_dedup._rare_first(df, 85, 100).join(df.select("node", "comp", "mark"), "node")
    got = {(r.a, r.b) for r in near_dedup._across(rare, 85, 100).collect()}
    own = [set(x.tolist()) for x in sets]
    want = {(i, j) for j in range(len(own)) for i in range(j) if 100 * len(own[i] & own[j]) >= 85 * len(own[i] | own[j]) and comp[i] != comp[j]}
    assert len(want) > 30 and want <= got and all(comp[i] != comp[j] for i, j in got)
    kept = {(r.a, r.b) for r in near_dedup.verified(spark.createDataFrame(sorted(got), "a long, b long"), df, 85, 100).collect()}
    assert kept == want


def test_near_duplicates(spark):
    texts = edits()
    comp, sizes = brute_components(texts)
    got = rows(near_dedup.near_duplicates(table(spark, texts)))
    assert [got[i].component_id for i in range(len(texts))] == comp
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = near_dedup.keep_one(table(spark, texts))
    assert kept.columns == table(spark, texts).columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(comp))


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(2)
    for share in (0.8, 0.9, 1.0):
        a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        b = np.concatenate([a[: int(2000 * share)], rng.integers(0, 2**63, 2000 - int(2000 * share), dtype=np.uint64)])
        x, y = (near_dedup.odd_sketch(near_dedup.samples_of(np.unique(s))) for s in (a, b))
        bits = sum(int(np.bitwise_count(np.uint64(int(v) & (2**64 - 1)))) for v in x ^ y)
        assert abs(near_dedup.estimate(bits) - share / (2 - share)) < 0.12


def test_fingerprints(spark, docs):
    got = rows(fingerprints.fingerprints(docs))
    n = len(TEXTS)
    for i, t in enumerate(TEXTS):
        own, nxt = t or "", TEXTS[(i + 1) % n] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprints.fingerprint(own).hex() and r.edited_fingerprint == fingerprints.fingerprint(edited).hex()
        assert r.near_next == fingerprints.likeness(fingerprints.fingerprint(own), fingerprints.fingerprint(nxt))
    assert got[5].fingerprint == got[6].fingerprint


def test_fingerprints_next_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 3)
    ids = [*range(-50, 50, 3), *range(10**12, 10**12 + 40), 7, 7]
    texts = [f"text number {i} with several words" for i in range(len(ids))]
    got = fingerprints.fingerprints(table(spark, texts, ids)).collect()
    want, order = Counter(), sorted(zip(ids, texts, strict=True), key=lambda x: (x[0], zlib.crc32(x[1].encode()), x[1]))
    for k, (i, t) in enumerate(order):
        half = len(t) // 2
        want[i, hashlib.sha256((t[: len(t) - half] + order[(k + 1) % len(order)][1][:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_fingerprints_of_text_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 4)
    ids = [f"https://example.org/{i:05d}" for i in range(30)] + ["", "b", "a", "é", "B", "100", "50", "a", None]
    texts = [f"text number {i} of many" for i in range(len(ids))]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id string, text string")
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    got = {(r.doc_id, r.edited_sha256) for r in fingerprints.marked(df).collect()}
    cut = lambda t, n: hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()
    assert got == {(i, cut(t, order[(k + 1) % len(order)][1])) for k, (i, t) in enumerate(order)}


def test_fingerprints_split_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 100)
    df = spark.createDataFrame([(5 if i < 1000 else i, f"words of row {i}") for i in range(1200)], "doc_id long, text string")
    got = fingerprints.with_next(df).groupBy("bucket").count().collect()
    assert len(got) >= 8 and max(r["count"] for r in got) < 400
    assert fingerprints.fingerprints(df).count() == 1200


def test_within_radius_finds_all(spark):
    rng = np.random.default_rng(4)
    marks = [bytes(rng.integers(0, 256, 16, dtype=np.uint8)) for _ in range(60)]
    for m in list(marks):
        x = int.from_bytes(m, "big")
        for bit in rng.choice(128, int(rng.integers(0, 6)), replace=False):
            x ^= 1 << int(bit)
        marks.append(x.to_bytes(16, "big"))
    df = spark.createDataFrame([(m.hex(),) for m in marks], "fingerprint string")
    got = {(r["query"], r["found"]): r["bits"] for r in fingerprints.within_radius(df, df, 3).collect()}
    bits = lambda a, b: (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    assert got == {(a.hex(), b.hex()): bits(a, b) for a in marks for b in marks if bits(a, b) <= 3}


def test_classifier(spark):
    rng = np.random.default_rng(6)
    plain = lambda i: " ".join(rng.choice(["the", "river", "runs", "over", "stones", "and", "grass", f"n{i}"], 60))
    loud = lambda i: " ".join(f"{w.upper()}!!" for w in rng.choice(["buy", "now", "cheap", f"m{i}"], 60))
    texts = [loud(i) if i % 3 == 0 else plain(i) for i in range(300)] + [None, "", LONG]
    df = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)] + [(9999, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = rows(classifier.scores(df, labels))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    right = [got[i].predicted == int(i % 3 != 0) for i in range(300) if got[i].held_out]
    assert len(right) > 40 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    kept = classifier.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    assert {r.score for r in classifier.scores(df, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in classifier.scores(df, labels.where("false")).collect()} == {0.5}


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Top</header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad">Buy</div><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First   para<b>graph</b> of
text.<p>Second.<aside>beside</aside><form>f<input></form><p>Third &lt;x&gt; &copy</p></article><div id="comments"><p>A long comment by a reader with many words in it.</p></div><footer>&copy; x</footer></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (2, None, None, 3), (3, "u", "", 3), (None, "u", "<p>only", 3), (5, "u", PAGE[: PAGE.index("Third")], 3)], "page_id long, url string, html string, n_chars int")
    got = rows(html_text.extract(pages), "page_id")
    assert got[1].text == "Head & line\n\nFirst paragraph of text.\n\nSecond.\n\nThird <x> ©"
    assert (got[2].text, got[3].text, got[None].text, got[2].url) == ("", "", "only", None)
    assert got[5].text == "Head & line\n\nFirst paragraph of text.\n\nSecond."
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.main_text("<body><div class=menu>a b c</div><div id=x><p>Long enough text of a page without article.<p>And more of it here</div><div class=sidebar>s</div>") == "Long enough text of a page without article.\n\nAnd more of it here"


LONGER = "A sentence of the main text with a good number of plain words in it, as articles have them. " * 3


def test_html_by_ratios():
    """Ratios, smoothing and threshold choose the regions; names only weigh."""
    text = html_text.main_text
    p = f"<p>{LONGER}</p>"
    whole = LONGER.strip()
    # Nothing of an article is lost: formulas, buttons, sections whose names mention a mark.
    got = text(f"<nav>n</nav><article><h1>Head</h1>{p}<p>Here <math><mi>x</mi></math> and <button>press</button></p><div class='related-work'><p>Short.</p></div><section id='search-methods'><p>Also.</p></section></article>")
    assert got == f"Head\n\n{whole}\n\nHere x and press\n\nShort.\n\nAlso."
    # Named parts go, in an article too, however long they are.
    assert text(f"<article>{p}<aside>{LONGER}</aside><div class='comment-list'>{p}</div></article><article class=comment>{p}</article>") == whole
    # A layout word on a container doesn't discard its text; teasers beside it go by their ratio.
    assert text(f"<ul><li><a href=/>Home</a></ul><div class='content has-sidebar'>{p}{p}<p>End.</p></div><div><a href=/><article>Card</article></a></div><div>(c) x</div>") == f"{whole}\n\n{whole}\n\nEnd."
    page = f"<div>{p}{p}</div><div><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div><div>{p}</div><div><span>(c)</span> <b>x</b> <i>y</i></div>"
    assert text(page) == f"{whole}\n\n{whole}\n\n{whole}" != text(page, lambda x: 0.0)
    # A page in one form is no form; one of named parts only is empty.
    assert text(f"<form><nav>menu words of the page</nav><h1>Head of all</h1>{p}</form>") == f"Head of all\n\n{whole}"
    assert text(f"<div id=comments>{p}</div><footer>{LONGER}</footer><form>{p}</form>") == ""


def test_html_long_and_deep():
    import time

    began = time.perf_counter()
    assert html_text.main_text("<div>" * 20_000 + f"<p>{LONGER}" + "</span></section>" * 20_000) == LONGER.strip()
    assert html_text.main_text(f"<div><article>{'<i class=x><b>' * 10_000}<p>{LONGER}" + "</div>" * 20_000) == LONGER.strip()
    assert len(html_text.main_text("<article>" + "<p>one two three four" * 30_000)) == 30_000 * 20 - 2
    assert time.perf_counter() - began < 30


def test_license_scan(spark):
    texts = ["x " * 30 + "Licensed under the Apache License, Version 2.0. and more", "nothing here at all to find in this text", "This work is licensed under the GNU General Public License, version 3.", None, "", "Released under the MIT License. Released under the MIT License.", LONG + " licensed under cc by-nc 4.0"]
    got = {(r.doc_id, r.license): r for r in license_scan.scan(table(spark, texts)).collect()}
    assert {k for k, r in got.items() if r.containment == 1.0} == {(0, "Apache-2.0"), (2, "GPL-3.0"), (5, "MIT"), (6, "CC-BY-NC-4.0")}
    assert got[0, "Apache-2.0"].first_word == 30 and got[5, "MIT"].n_windows == 2
    assert got[2, "GPL-2.0"].containment == 0.875
    with pytest.raises(ValueError):
        license_scan.scan(table(spark, texts), {"short": "MIT License"})
    # Texts shorter than a template, standard paragraphs, one with changed words, and parts of one.
    body = license_scan.NOTICES["MIT permission"]
    cut = body.split()
    texts = ["work is licensed under the GNU General Public License, version 3", "x y z " + body + " and so on", " ".join(w if i not in (20, 50) else "other" for i, w in enumerate(cut)), " ".join(cut[:30]), LONG + " " + body + " " + LONG]
    got = {(r.doc_id, r.license): r for r in license_scan.scan(table(spark, texts)).collect()}
    assert got[0, "GPL-3.0"].containment == 0.875 and got[0, "GPL-3.0"].first_word == 0
    assert got[1, "MIT permission"].first_word == 3 and got[1, "MIT permission"].containment == got[4, "MIT permission"].containment == 1.0
    assert 0.8 <= got[2, "MIT permission"].containment < 1.0 and (3, "MIT permission") not in got


def test_license_scan_against_all_windows(spark):
    """Every window of every text by brute force: damaged, repeated and cut templates, a long one that shares its beginning with another, ids of type string."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    whole = " ".join(r.choice(vocabulary) for _ in range(400))
    notices = {"whole": whole, "first half": " ".join(whole.split()[:200]), "short": "Licensed under the Example License", "MIT permission": license_scan.NOTICES["MIT permission"]}
    texts = [None, "", "licensed under the example", whole + "\n" + whole]
    for _ in range(40):
        body = r.choice(list(notices.values())).split()
        share = r.choice([0, 0.01, 0.03, 0.06, 0.2])
        body = [r.choice(vocabulary) if r.random() < share else w for w in body][r.choice([0, 0, 0, 30]) :]
        around = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(60))) for _ in range(2)]
        texts.append(f"{around[0]} ({' '.join(body)}) {around[1]}" + " ".join(body) * r.choice([0, 0, 1]))

    def cut(text):
        own = [w.strip(string.punctuation) for w in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
        own = [w for w in own if w]
        return [tuple(own[i : i + 5]) for i in range(len(own) - 4)]

    want = {}
    for i, text in enumerate(texts):
        found = cut(text)
        for name, body in notices.items():
            own, n = set(cut(body)), len(cut(body))
            held = [len(own & set(found[a : a + n])) / len(own) for a in range(max(1, len(found) - n + 1))]
            if max(held) >= 0.8:
                want[f"id {i}", name] = (max(held), held.index(max(held)), sum(h >= 0.8 for h in held))
    df = spark.createDataFrame([(f"id {i}", t, 1.0) for i, t in enumerate(texts)], "doc_id string, text string, containment double")
    got = {(x.doc_id, x.license): (x.containment, x.first_word, x.n_windows) for x in license_scan.scan(df, notices).collect()}
    assert got == want and {k[1] for k in want} == set(notices)


def test_warc_audit(spark):
    page = "page_id long, url string, html string"
    pages = [(i, f"http://x/{i}", f"<p>{i}") for i in range(0, 9000, 7)] + [(None, None, None), (3, "u", None), (3, "u", "twice")]
    other = [(i, u, h + "!" if i == 700 else "#" + h[1:] if i == 2800 else h) for i, u, h in pages if i != 4200] + [(8_000_000, "v", "new")]
    got = warc_fixity.audit(spark.createDataFrame(pages, page), spark.createDataFrame(other, page)).collect()
    by = {k: sorted(r.page_id for r in got if r.status == k) for k in ("corrupt", "missing", "extra")}
    assert by == {"corrupt": [700, 2800], "missing": [4200], "extra": [8_000_000]}
    assert len(got) == len(pages) + 1
    files = {i // 256 for i in (700, 4200)}
    assert all(r.file in files for r in got if r.status == "moved")
    same = warc_fixity.audit(spark.createDataFrame(pages, page), spark.createDataFrame(pages, page)).collect()
    assert {r.status for r in same} == {"ok"}


def test_warc_files_round_trip(spark, tmp_path):
    """Files hold the records at the offsets that the trees are made of; odd bodies, ids and a clashing column don't disturb them."""
    pages = [(i, f"http://x/{i}", body, 1) for i, body in enumerate(["<p>é日", "", None, "a\r\n\r\nb", "WARC/1.1\r\n", LONG, "x"] * 80)] + [(3, "u", "twice", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, file int")
    warc_fixity.write_warc(df, f"{tmp_path}/warc")
    got = {(r.file, r.ordinal): (r.start, r.length, r.sha) for r in warc_fixity.read_warc(spark, f"{tmp_path}/warc").collect()}
    want = {(r.file, r.ordinal): (r.start, r.length, r.sha) for r in warc_fixity.records(df, 0, 1 << 40).collect()}
    assert got == want and len(got) == len(pages)
    bodies = {r.url: bytes(r.body) for r in warc_fixity.read_warc(spark, f"{tmp_path}/warc").collect()}
    assert all(bodies[u] == (h or "").encode() for _, u, h, _ in pages)


def test_warc_reader_passes_over_what_is_no_record(spark, tmp_path):
    import gzip

    good = lambda url, body, name=b"Content-Length": b"WARC/1.1\r\nWARC-Type: response\r\nwarc-target-uri: " + url + b"\r\n" + name + b": " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    raw = b"junk\r\n\r\n" + good(b"one", b"first", b"content-length") + b"WARC/1.1\r\nContent-Length: many\r\n\r\nlost\r\n\r\n" + good(b"tw\xff", b"second") + good(b"cut", b"x" * 50)[:-20]
    for k, data in enumerate((raw, gzip.compress(raw[:60]) + gzip.compress(raw[60:]))):
        (tmp_path / f"file={k}").mkdir()
        (tmp_path / f"file={k}" / "a.warc").write_bytes(data)
    got = sorted((r.file, r.ordinal, r.url, bytes(r.body)) for r in warc_fixity.read_warc(spark, str(tmp_path)).collect())
    assert got == [(k, i, u, b) for k in (0, 1) for i, u, b in ((0, "one", b"first"), (1, "tw\ufffd", b"second"))]


def test_warc_audit_of_text_ids(spark):
    pages = [(f"p{i}", f"http://x/{i}", f"<p>{i}") for i in range(40)] + [("17", "u", "number"), (None, "u", "none")]
    df = spark.createDataFrame(pages, "page_id string, url string, html string")
    other = spark.createDataFrame([(i, u, "changed" if i == "p5" else h) for i, u, h in pages if i != "p9"], df.schema)
    assert {r.status for r in warc_fixity.audit(df, df).collect()} == {"ok"} and len(warc_fixity.audited(df).collect()) >= len(pages)
    got = warc_fixity.audit(df, other).collect()
    assert {r.page_id for r in got} == {i for i, _, _ in pages}
    assert all(r.status != "ok" for r in got if r.page_id in ("p5", "p9")) and sum(r.status == "ok" for r in got) >= 1


def test_html_topics_and_short_blocks_stay():
    long = lambda w, n=80: " ".join([w] * n)
    page = f"<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{long('word')}</p><section id='search'><p>{long('algorithm')}</p></section><div class='social'>{long('people', 120)}</div><div class='share'><a href=1>Tweet</a></div><div class='comments'><p>{long('nice')}</p></div></article><div class='search'>{long('outside')}</div></body>"
    got = html_text.main_text(page)
    assert all(x in got for x in ("word", "algorithm", "people")) and not any(x in got for x in ("Tweet", "nice", "outside", "Home"))
    plain = f"<body><div>{long('alpha', 100)}</div><div>Second para here.</div><div>{long('gamma', 90)}</div><div><a href=1>More</a> <a href=2>links</a></div><div class='ads'>Short advert here.</div><div>{long('delta', 90)}</div></body>"
    assert html_text.main_text(plain) == "\n\n".join([long("alpha", 100), "Second para here.", long("gamma", 90), long("delta", 90)])


def test_fingerprint_by_brute_force(spark, docs):
    """Votes of all terms bit by bit, likeness of neighbours, and the search against all pairs."""
    import xxhash

    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 32)) * 0x9E3779B97F4A7C15 & mask
        x = (x ^ (x >> 29)) * 0xD6E8FEB86659FD93 & mask
        return x ^ (x >> 32)

    def slow(text):
        h = [xxhash.xxh3_64_intdigest(w) for w in text.encode().lower().split()]
        if not h:
            return bytes(16).hex()
        terms = Counter(mix((a * 3 + mix(b)) & mask) for a, b in zip(h, h[1:])) if len(h) > 1 else Counter([mix(h[0])])
        votes = np.zeros(128)
        for t, n in terms.items():
            raw = b"".join(mix((t + k * 0x9E3779B97F4A7C15) & mask).to_bytes(8, "little") for k in range(2))
            votes += n**0.5 * (np.unpackbits(np.frombuffer(raw, np.uint8)) * 2.0 - 1)
        return np.packbits(votes >= 0).tobytes().hex()

    got = rows(fingerprints.marked(docs, every=3))
    for i, t in enumerate(TEXTS):
        if len(words(t)) < 300:
            assert got[i].fingerprint == slow(t or ""), i
        nxt = (TEXTS[(i + 1) % len(TEXTS)] or "") if len(TEXTS) > 1 else ""
        half = len(t or "") // 2
        edited = fingerprints.fingerprint((t or "")[: len(t or "") - half] + nxt[:half])
        assert got[i].near_edited == fingerprints.likeness(bytes.fromhex(got[i].fingerprint), edited)
        bits = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
        assert got[i].near_queries == sum(bits(got[i].fingerprint, got[q].fingerprint) <= 3 for q in got if q % 3 == 0)


def test_best_fit_against_optimum():
    """Bins of best-fit decreasing and the certified bound against the least number of bins, by search."""
    from functools import cache

    def least_bins(sizes, capacity):
        @cache
        def go(left, free):
            if not left:
                return len(free)
            s, rest = left[0], left[1:]
            tries = {tuple(sorted((*free[:i], f - s, *free[i + 1 :]))) for i, f in enumerate(free) if f >= s} | {tuple(sorted((*free, capacity - s)))}
            return min(go(rest, t) for t in tries)

        return go(tuple(sorted(sizes, reverse=True)), ())

    rng = np.random.default_rng(12)
    for _ in range(60):
        sizes = rng.integers(1, 21, int(rng.integers(1, 9)))
        best = least_bins(sizes.tolist(), 20)
        fill = packing.best_fit(sizes, 20)[2]
        assert packing.lower_bound(sizes, 20) <= best <= len(fill) <= best * 11 / 9 + 1


def test_empty_tables(spark):
    none = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    tok = pytest.importorskip("public_tokenizers")
    for df in (quality_rules.verdicts(none), quality_rules.keep_good(none), classifier.scores(none, labels), bpe.digests(none), sharding.assign(none), packing.packed(none), near_dedup.near_duplicates(none), near_dedup.keep_one(none), fingerprints.marked(none), html_text.extract(pages), license_scan.scan(none), warc_fixity.audited(pages)):
        assert df.collect() == []
    assert tok


def test_null_and_repeated_ids(spark):
    df = table(spark, ["same words in this text of ours"] * 3 + ["other words stand in this one"], [None, 4, 4, None])
    assert len(quality_rules.verdicts(df).collect()) == len(sharding.assign(df).collect()) == len(fingerprints.marked(df).collect()) == 4
    got = near_dedup.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert sorted(str(r.doc_id) for r in near_dedup.keep_one(df).collect()) == ["4", "None"]
    assert len(packing.packed(df).collect()) == len(bpe.digests(df).collect()) == 4


def test_keep_one_judges_rows_by_text(spark):
    other = " ".join(f"other{i}" for i in range(60))
    hot = [" ".join(f"hot{k}x{i}" for i in range(40)) for k in range(5)]
    df = table(spark, [BASE, BASE + " tail", other, *hot, None, ""], [0, 1, 1, *[7] * 5, 8, 8])
    got = near_dedup.keep_one(df)
    assert got.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(0, BASE), (1, other), *((7, t) for t in hot), (8, None), (8, "")])
    got = near_dedup.near_duplicates(table(spark, [BASE, BASE + " tail"], [None, 3])).collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in sorted(got, key=lambda r: r.kept)] == [(None, 3, False), (3, 3, True)]
