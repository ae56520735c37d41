import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from martlet.llm.exact import ExactGroups

from .conftest import odd_rows


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r)[:4] for r in frame.select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)


def test_groups_of_odd_rows(odd):
    assert found(ExactGroups(odd).assignments()) == expected(odd_rows())


def test_digest_is_of_the_text(odd):
    rows = ExactGroups(odd).assignments().select("doc_id", "_digest").collect()
    digests = {bytes(r["_digest"]).hex() for r in rows}
    assert digests == {hashlib.sha256((r[1] or "").encode()).hexdigest() for r in odd_rows()}


def test_colliding_digests_compare_whole_texts(odd):
    def weak(text):
        return F.unhex(F.hex(F.crc32(text.cast("binary")) % 2))

    assert found(ExactGroups(odd, digest=weak).assignments()) == expected(odd_rows())
    assert found(ExactGroups(odd, digest=weak, hot_share=0.1).assignments()) == expected(odd_rows())


def test_hot_groups_are_salted_and_whole(spark):
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16)
    groups = ExactGroups(docs, hot_share=0.05, salts=4)
    assert groups.any_hot
    assert found(groups.assignments()) == expected(rows)
    assert "EvalPython" not in groups.assignments()._jdf.queryExecution().toString()


def test_one_survivor_for_each_text(odd):
    kept = ExactGroups(odd).survivors()
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == len({r[1] or "" for r in odd_rows()})
    assert {(r["doc_id"], r["text"] or "") for r in rows} == {
        (k, t) for t, k in {(r[1] or ""): max((x[0] for x in odd_rows() if (x[1] or "") == (r[1] or "") and x[0] is not None), default=None) for r in odd_rows()}.items()
    }
    assert [r["text"] for r in rows if r["doc_id"] == 4] == [""]


def test_survivors_of_maps_and_hot_groups(spark):
    docs = spark.sql("SELECT id AS doc_id, 'same' AS text, map('k', id) AS _digest, id AS _size FROM range(50)")
    (one,) = ExactGroups(docs, hot_share=0.1, salts=3).survivors().collect()
    assert one["doc_id"] == 49 and one["_digest"] == {"k": 49} and one["_size"] == 49


def test_empty_table(empty):
    assert ExactGroups(empty).assignments().count() == 0
    assert ExactGroups(empty).survivors().count() == 0
