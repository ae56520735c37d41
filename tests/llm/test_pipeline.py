import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

from martlet.llm import registry  # noqa: E402
from martlet.llm.common import keep  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = keep(stage(spark, docs, FOLDER), f"test-{name}")
    return out


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_stages_keep_the_columns_and_only_drop_rows(stages):
    names = ["documents", *[n for n, _ in corpus_pipeline.STAGES[:-1]]]
    for before, after in zip(names, names[1:]):
        assert stages[after].columns == stages["documents"].columns
        assert not rows_of(stages[after]) - rows_of(stages[before])
    assert stages["packing"].count() > 0


def test_each_decision_takes_effect(stages, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["quality"].collect()}
    right = [(d in kept) == bool(q) for d, q in labels.items()]
    assert sum(right) > 0.95 * len(right)
    texts = Counter(r["text"] for r in stages["exact_dedup"].collect())
    assert max(texts.values()) == 1 and set(texts) == {r["text"] for r in stages["quality"].collect()}
    packed = {r["doc_id"] for r in stages["packing"].collect()}
    assert packed == {r["doc_id"] for r in stages["mixing"].collect()}


def test_stages_on_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = keep(stage(spark, rows, FOLDER), f"odd-{name}")
            if name != "packing":
                assert rows.columns == docs.columns
        rows.count()


@pytest.mark.parametrize("name", list(registry.ORACLE))
def test_queries_match_sql(spark, name):
    assert compare(spark, connect(FOLDER), name, registry.QUERIES[name], registry.ORACLE[name], FOLDER) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 11))
