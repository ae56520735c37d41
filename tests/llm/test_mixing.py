import hashlib
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from martlet.llm import mixing


def pour(budget, children):
    """children: {name: (capacity, weight)}; the shares, by repeated filling."""
    given = {c: Fraction(0) for c in children}
    open_ = {c for c, (capacity, weight) in children.items() if weight > 0 and capacity > 0}
    left = Fraction(budget)
    while open_ and left > 0:
        total = sum(children[c][1] for c in open_)
        full = {c for c in open_ if given[c] + left * children[c][1] / total >= children[c][0]}
        if not full:
            for c in open_:
                given[c] += left * children[c][1] / total
            break
        for c in full:
            left -= children[c][0] - given[c]
            given[c] = Fraction(children[c][0])
        open_ -= full
    return given


def slow_budgets(leaves, mix):
    def weight(k, name):
        return mix.weights.get(mix.levels[k], {}).get(name, mix.default)

    def capacity(prefix):
        return sum(t * mix.max_epochs for key, t in leaves.items() if key[: len(prefix)] == prefix)

    out = {}

    def walk(prefix, budget):
        k = len(prefix)
        if k == len(mix.levels):
            out[prefix] = budget
            return
        names = {key[k] for key in leaves if key[:k] == prefix}
        for name, share in pour(budget, {n: (capacity((*prefix, n)), weight(k, n)) for n in names}).items():
            walk((*prefix, name), int(share))

    most, least = mix.budget_share
    walk((), sum(leaves.values()) * most // least)
    return out


def slow_times(rows, mix):
    """rows: (key, id, text); how often each is taken, by the definition."""
    leaves = defaultdict(int)
    for key, _, text in rows:
        leaves[key] += len((text or "").split())
    budgets = slow_budgets(leaves, mix)
    out = []
    for key, own, text in rows:
        tokens, budget = leaves[key], budgets[key]
        epochs = budget // tokens if tokens else 0
        rest = budget - epochs * tokens

        def place(i, t):
            name = f"{mix.seed}-{epochs}-{'' if i is None else i}"
            return hashlib.md5(name.encode()).hexdigest(), hashlib.md5((t or "").encode()).hexdigest()

        before = sum(len((t or "").split()) for k, i, t in rows if k == key and place(i, t) <= place(own, text))
        out.append((key, own, text, epochs + (1 if rest > 0 and before <= rest else 0)))
    return sorted(out, key=repr)


def test_budgets_by_repeated_filling(spark):
    mix = mixing.Mix(("a", "b", "c"), {"a": {"x": 3, "y": 1}, "b": {"p": 5, "q": 0}, "c": {"1": 2}}, max_epochs=2, budget_share=(3, 2))
    leaves = {("x", "p", "1"): 10, ("x", "p", "2"): 700, ("x", "q", "1"): 900, ("y", "p", "1"): 40, ("y", "r", None): 800, (None, "p", "1"): 5, ("y", "r", "3"): 0}
    frame = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "a string, b string, c string, tokens bigint")
    got = {(r["a"], r["b"], r["c"]): r["budget"] for r in mixing.plan_budgets(frame, mix).collect()}
    want = slow_budgets(leaves, mix)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1 for k in want)
    assert got[("x", "q", "1")] == 0


def test_times_of_documents(documents):
    docs = mixing.with_domain(documents)
    for mix in (mixing.DOCUMENT_MIX, mixing.Mix(mixing.LEVELS, {}, budget_share=(9, 10), max_epochs=1)):
        got = mixing.take(docs, mixing.plan_mixture(docs, mix), mix).select(*mix.levels, "doc_id", "text", "_mix_times").collect()
        rows = [(tuple(r)[:3], r["doc_id"], r["text"]) for r in got]
        assert sorted(((tuple(r)[:3], r["doc_id"], r["text"], r["_mix_times"]) for r in got), key=repr) == slow_times(rows, mix)
        picked = mixing.selected(docs, mix).groupBy("doc_id").count().collect()
        assert {r["doc_id"]: r["count"] for r in picked} == {r["doc_id"]: r["_mix_times"] for r in got if r["_mix_times"]}


def test_a_leaf_with_most_rows_is_cut_exactly(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("two words").alias("text"), F.lit("hot").alias("s"))
    mix = mixing.Mix(("s",), budget_share=(1, 3), max_epochs=1)
    assert mixing.selected(docs, mix).count() == 20_000 * 2 // 3 // 2


def test_odd_rows(odd):
    docs = mixing.with_domain(odd)
    mix = mixing.Mix(mixing.LEVELS, budget_share=(1, 2))
    got = mixing.take(docs, mixing.plan_mixture(docs, mix), mix).select(*mix.levels, "doc_id", "text", "_mix_times").collect()
    rows = [(tuple(r)[:3], r["doc_id"], r["text"]) for r in got]
    assert sorted(((tuple(r)[:3], r["doc_id"], r["text"], r["_mix_times"]) for r in got), key=repr) == slow_times(rows, mix)
    kept = mixing.selected(odd.drop("_mix_place").withColumn("_mix_domain", F.lit("d")), mix)
    assert kept.columns[:3] == odd.columns[:3]


def test_empty_table(empty):
    docs = mixing.with_domain(empty)
    assert mixing.selected(docs, mixing.DOCUMENT_MIX).count() == 0


def test_no_python_in_the_plan(documents):
    docs = mixing.with_domain(documents)
    plan = mixing.take(docs, mixing.plan_mixture(docs, mixing.DOCUMENT_MIX), mixing.DOCUMENT_MIX)
    assert "Python" not in plan._jdf.queryExecution().toString()
