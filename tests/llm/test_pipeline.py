"""The pipeline's stages against brute force, on planted documents."""

from __future__ import annotations

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
tokenizers, tok = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")

from tidewatch.llm import classifier, quality_rules  # noqa: E402

from .test_corpus import brute_components, rows  # noqa: E402

N = 240


def documents():
    """Clean texts, loud ones that only labels tell apart, junk that rules reject, exact and near copies."""
    rng = np.random.default_rng(11)
    words = [f"river{i} stone{i} grass{i} cloud{i}" for i in range(400)]
    out = []
    for i in range(N):
        text = " ".join(rng.choice(words, 20))
        if i % 6 == 1:
            text = text.upper().replace(" ", "!! ")
        elif i % 12 == 2:
            text = " ".join(f"{w}***" for w in text.split())
        elif i % 12 == 3:
            text = " ".join(text.split()[:5])
        elif i % 12 == 5:
            text = out[i - 5]
        elif i % 12 == 6:
            text = out[i - 6] + " one more"
        out.append(text)
    return out


def test_pipeline(spark, tmp_path):
    texts = documents()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 6 != 1), 0) for i in range(N) if i % 3], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "MinHash near-dedup", "best-fit packing"]
    ruled = docs.join(quality_rules.verdicts(docs).where("kept").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    good = rows(classifier.scores(ruled, labels))
    left = [i for i in sorted(good) if good[i].predicted]
    assert {i for i in left if i % 6 == 1} == set() and len(left) > N // 2
    comp, _ = brute_components([texts[i] for i in left])
    kept = sorted({left[c] for c in comp})
    assert len(kept) < len(left)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    own = tokenizers.Tokenizer.from_file(tok.path("byte_bpe_50k.json"))
    assert sorted({r.doc_id for r in got}) == kept
    for i in kept:
        assert sum(r.length for r in got if r.doc_id == i) == len(own.encode(texts[i], add_special_tokens=False).ids) + 1
    docs_now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        docs_now = stage(spark, docs_now, str(tmp_path))
        assert docs_now.columns == docs.columns, k


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty, very long and repeated rows, clashing columns, and no rows at all, stage by stage."""
    long = " ".join(f"river{i % 311} stone{i % 97}x{i}" for i in range(30_000))
    plain = [" ".join(f"tree{k}x{i}" for i in range(40)) for k in range(6)]
    texts = [None, "", long, long, plain[0], plain[0], *plain[1:], "few words"]
    ids = [None, 1, 2, 2, None, 3, 4, 5, 6, 7, 8, 9]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _score double, _row long, node long, _m_words string, uid int"
    docs = spark.createDataFrame([(i, t, None, None, None, None, 5, None, None, 1) for i, t in zip(ids, texts, strict=True)], schema)
    spark.createDataFrame([(4, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    want = [{2, 3, 4, 5, 6, 7, 8, None}, {2, 3, 4, 5, 6, 7, 8, None}, {2, 3, 4, 5, 6, 7, 8}]
    for (name, stage), ids_left in zip(corpus_pipeline.STAGES[:3], want, strict=True):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        assert {r.doc_id for r in now.collect()} == ids_left, name
    assert now.count() == 7
    packed = corpus_pipeline.STAGES[3][1](spark, now, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == want[2]
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, empty, str(tmp_path))
        assert got.collect() == [], name
        empty = got if name != "best-fit packing" else empty
