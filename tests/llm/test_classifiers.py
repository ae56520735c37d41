import os
import subprocess
import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from martlet.llm import language, quality

from .conftest import odd_rows, words


def test_blocks_give_the_same_features_as_one_pass(monkeypatch):
    text = words(5, 500) + " Été 東京 " + "long" * 40
    whole = np.sort(np.concatenate(list(quality.features(text))))
    monkeypatch.setattr(quality, "_BLOCK_BYTES", 300)
    assert np.array_equal(np.sort(np.concatenate(list(quality.features(text)))), whole)
    counted = language.counts(text)
    monkeypatch.setattr(language, "_BLOCK", 64)
    assert np.array_equal(language.counts(text), counted)


def test_features_are_words_and_inner_ngrams():
    assert len(next(quality.features("abcd"))) == 1 + 4 + 3  # the word; " ab" to "cd "; " abc" to "bcd "
    assert np.array_equal(*[np.sort(next(quality.features(t))) for t in ("a b", " a\n\tb ")])
    assert len(next(quality.features(""))) >= 1


def test_training_separates(spark):
    rng = np.random.default_rng(0)
    texts = [(" ".join(rng.choice(["good", "fine", "text"], 20)), 1) for _ in range(60)]
    texts += [(" ".join(rng.choice(["###spam", "$$$", "!!buy"], 20)), 0) for _ in range(60)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, q) for k, (_, q) in enumerate(texts)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    rows = quality.scores(docs, model).collect()
    assert all((r["score"] > 0.5) == bool(texts[r["row"]["doc_id"]][1]) for r in rows)
    assert {r["doc_id"] for r in quality.accepted(docs, model).collect()} >= set(range(60))


def test_quality_never_learns_from_the_held_out_fold(documents, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    used = quality.training_rows(documents, labels).collect()
    assert used and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 for r in used)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in quality.op7_quality_classifier(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


@pytest.mark.parametrize("kinds", [(), (1,), (0,)])
def test_quality_without_contrast(spark, odd, kinds):
    labels = spark.createDataFrame([(k, q) for k in (1, 2, 7, 9) for q in kinds], "doc_id bigint, quality int")
    rows = quality.scores(odd, quality.fit(odd, labels)).collect()
    want = 0.5 if not kinds else float(kinds[0])
    assert len(rows) == len(odd_rows()) and all(abs(r["score"] - want) < 1e-5 for r in rows)


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (9, None), (None, 1), (11, 0), (11, 1)], "doc_id bigint, quality int")
    model = quality.fit(odd, labels)
    rows = quality.scores(odd, model).collect()
    by_text = {}
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert by_text.setdefault(r["row"]["text"] or "", r["score"]) == r["score"]
    assert quality.accepted(odd, model, 0.0).columns == odd.columns
    assert quality.accepted(odd, model, 0.0).count() == len(odd_rows())
    assert quality.accepted(empty, model).count() == 0 and quality.fit(empty, labels).margins().shape


def test_held_out_language(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = [r for r in language.op10_language_id(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in rows]) > 0.97
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)


def test_language_of_odd_rows(spark, odd, empty, documents):
    model = language.fit(documents)
    rows = language.predictions(odd, model).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        if r["doc_id"] in (3, 4, 8):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model.langs
    assert language.predictions(empty, model).count() == 0
    assert language.fit(empty).predict("text", language.BUCKET_BITS) == ("und", 0.0, True)
    digits = spark.createDataFrame([(1, "123 !!"), (2, "² ³")], "doc_id bigint, text string")
    assert [r["lang_pred"] for r in language.predictions(digits, model).collect()] == ["und", "und"]


def test_far_texts_are_rejected(documents):
    model = language.fit(documents)
    assert model.predict("zzqx xqzz qqzx " * 30, language.BUCKET_BITS)[2]
    near = [model.predict(r["text"], language.BUCKET_BITS)[2] for r in documents.limit(100).collect()]
    assert np.mean(near) < 0.1


def test_clusters_find_separate_groups():
    rng = np.random.default_rng(1)
    centres = np.eye(3, 20)
    x = np.repeat(centres, 30, axis=0) + rng.normal(0, 0.02, (90, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = language.cluster(x, 3, seed=2)
    assert np.allclose(np.linalg.norm(found, axis=1), 1)
    assert len(language.cluster(x[:2], 3)) == 2


def test_training_reads_the_features_in_place():
    rng = np.random.default_rng(3)
    ids = rng.permutation(200)
    sizes = rng.integers(200, 400, 200)
    buckets = [np.sort(rng.choice(1 << quality.BUCKET_BITS, n, replace=False)).astype("<i4") for n in sizes]
    shares = [np.full(n, 1 / n, "<f4") for n in sizes]
    table = pa.table({
        "doc_id": pa.array(ids), "quality": pa.array(ids % 2, pa.int32()),
        "buckets": pa.array([b.tobytes() for b in buckets]), "shares": pa.array([s.tobytes() for s in shares]),
    })
    table = pa.concat_tables([table.slice(0, 70), table.slice(70)])  # a group comes in several batches
    tracemalloc.start()
    rows, labels = quality.training_views(table)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < table.nbytes / 2
    order = np.argsort(ids)
    assert np.array_equal(labels, ids[order] % 2)
    copies = [(buckets[k], shares[k].astype(float)) for k in order]
    assert all(np.array_equal(b, x) and np.array_equal(s, y) for (b, s), (x, y) in zip(rows, copies))
    one, other = quality.train(rows, labels), quality.train(copies, labels)
    assert np.array_equal(one.vectors, other.vectors) and np.array_equal(one.margins(), other.margins())


def test_workers_of_the_pipeline_load_no_pandas():
    code = "import sys, corpus_pipeline; sys.exit('pandas' in sys.modules)"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0
