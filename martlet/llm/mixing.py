"""Mixing sources to target weights: a budget for every leaf of a tree, and a seeded prefix of its rows.

The tree has the levels domain, language and source.  The total budget of tokens flows down by weights.
What a leaf can give is its tokens times the number of epochs allowed.  A node that cannot use its share
gives the rest to its siblings, in proportion to their weights, before anything goes back to an ancestor:
every parent pours its budget over its children up to what their subtrees can give.  The water level of
such a pour is found from running sums over the children in order of capacity per weight, without
iteration, so the whole plan is a few windows over the (small) table of tree nodes.

A leaf then repeats whole epochs as long as its budget reaches and takes a token-prefix of one more,
whose order is a hash of seed, epoch and id.  The prefix is found in two steps, so that a leaf that holds
a third of all rows never meets in one task: tokens are summed for each leaf and hash bucket (map-side),
running sums over the 4096 buckets of each leaf find the one in which the budget ends, and only that
bucket's rows are put in order.  The result is one cut for each leaf, and every row compares its own
place with it: texts are never shuffled.

Only Columns are used.  Defined cases: a null text has no tokens.  A null level value is a leaf of its
own with the default weight; a weight of zero gives nothing.  A null id counts as empty text in the
order; rows with equal places are ordered by a hash of their text, and rows that are equal in both are
taken together or not at all.  A leaf without tokens or without budget gives no rows.  An empty table
gives an empty result.  Columns of other names are carried along; the internal ones start with ``_mix_``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import documents, keep

BUCKET_DIGITS = 3  # hexadecimal digits of the order that name a bucket


@dataclass(frozen=True)
class Mix:
    """Target weights (whole numbers) by level and value; values not named weigh ``default``."""

    levels: Sequence[str]
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default: int = 1
    budget_share: tuple[int, int] = (1, 2)  # of the tokens of the whole table
    max_epochs: int = 4
    seed: str = "mix"

    def weight(self, level: str) -> Column:
        out = F.lit(self.default)
        for value, weight in sorted(self.weights.get(level, {}).items()):
            out = F.when(F.col(level) == value, weight).otherwise(out)
        return out.cast("bigint")


def word_tokens(text: Column) -> Column:
    """Number of words separated by ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def _join(left: DataFrame, right: DataFrame, levels: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on level columns, null being a value like any other; ``right`` gives no second copy of them."""
    named = right.select(*[F.col(c).alias(f"_mix_key_{c}") if c in levels else F.col(c) for c in right.columns])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_mix_key_{c}")) for c in levels])
    return left.join(named, same, how).drop(*[f"_mix_key_{c}" for c in levels])


def _family(levels: Sequence[str]) -> W:
    return W.partitionBy(*levels) if levels else W.partitionBy(F.lit(0))


def plan_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (level columns and ``tokens``) with ``budget``."""
    levels, depth = list(mix.levels), len(mix.levels)
    most, least = mix.budget_share
    tree = leaves.withColumn("_mix_all", F.sum("tokens").over(_family([])))
    tree = tree.withColumn("_mix_budget_0", F.expr(f"(_mix_all * {most}) div {least}")).drop("_mix_all")
    tree = tree.withColumn(f"_mix_capacity_{depth}", F.col("tokens") * mix.max_epochs)
    for k in range(1, depth):  # what each subtree can give
        tree = tree.withColumn(f"_mix_capacity_{k}", F.sum(f"_mix_capacity_{depth}").over(W.partitionBy(*levels[:k])))
    for k in range(1, depth + 1):
        tree = _pour(tree, mix, k)
    return tree.select(*leaves.columns, F.col(f"_mix_budget_{depth}").alias("budget"))


def _pour(tree: DataFrame, mix: Mix, k: int) -> DataFrame:
    """Budgets of level ``k`` from those of its parents.

    Children are taken by capacity per weight.  With C the capacities before a child and S the weights
    from it on, (B - C) / S is the water level at the first child whose own capacity per weight it does
    not exceed; for all later children that quotient is smaller, so it is the greatest such quotient.
    """
    parent, child = list(mix.levels[: k - 1]), list(mix.levels[:k])
    capacity, budget, weight = F.col(f"_mix_capacity_{k}"), F.col(f"_mix_budget_{k - 1}"), F.col("_mix_weight")
    nodes = tree.groupBy(*child).agg(
        F.max(capacity).alias(f"_mix_capacity_{k}"), F.max(budget).alias(f"_mix_budget_{k - 1}")
    )
    nodes = nodes.withColumn("_mix_weight", mix.weight(child[-1])).withColumn(
        "_mix_ratio", F.when(weight > 0, capacity.cast("double") / weight).otherwise(F.lit(float("inf")))
    )
    order = _family(parent).orderBy(F.col("_mix_ratio"), F.col(child[-1]).asc_nulls_first())
    before = F.coalesce(F.sum(capacity).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(weight).over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    nodes = nodes.withColumn("_mix_level", F.when(rest > 0, (budget - before).cast("double") / rest))
    found = F.when(F.col("_mix_level") <= F.col("_mix_ratio"), F.col("_mix_level"))
    nodes = nodes.withColumn("_mix_water", F.max(found).over(_family(parent)))
    given = (
        F.when(weight == 0, F.lit(0))
        .when(F.col("_mix_water").isNull(), capacity)
        .otherwise(F.least(capacity, F.floor(weight * F.col("_mix_water"))))
    )
    return _join(tree, nodes.select(*child, given.cast("bigint").alias(f"_mix_budget_{k}")), child)


def _place(mix: Mix, epoch: Column, row_id: Column) -> Column:
    parts = [F.lit(mix.seed), epoch.cast("string"), F.coalesce(row_id.cast("string"), F.lit(""))]
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def _text_hash() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def plan_mixture(docs: DataFrame, mix: Mix) -> DataFrame:
    """One row for each leaf: its tokens, rows, budget, whole epochs, and the place at which the last epoch ends."""
    levels = list(mix.levels)
    slim = keep(
        docs.select(
            F.col("doc_id").alias("_mix_id"), _text_hash().alias("_mix_text"), *levels, word_tokens(F.col("text")).alias("tokens")
        ),
        "mix-rows",
    )
    leaves = keep(slim.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "mix-leaves")
    plan = plan_budgets(leaves, mix)
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("bigint"))
    plan = keep(plan.withColumn("remainder", F.col("budget") - F.col("epochs") * F.col("tokens")), "mix-plan")

    rows = _join(slim, plan.select(*levels, "epochs", "remainder"), levels)
    rows = rows.withColumn("_mix_place", _place(mix, F.col("epochs"), F.col("_mix_id"))).withColumn(
        "_mix_bucket", F.substring("_mix_place", 1, BUCKET_DIGITS)
    )
    buckets = rows.groupBy(*levels, "remainder", "_mix_bucket").agg(F.sum("tokens").alias("_mix_sum"))
    earlier = W.partitionBy(*levels).orderBy("_mix_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.withColumn("_mix_start", F.coalesce(F.sum("_mix_sum").over(earlier), F.lit(0)))
    start, remainder = F.col("_mix_start"), F.col("remainder")
    ends = buckets.filter((remainder > 0) & (start <= remainder) & (start + F.col("_mix_sum") > remainder))
    ends = keep(ends.select(*levels, F.col("_mix_bucket").alias("_mix_end"), "_mix_start"), "mix-ends")

    inside = _join(rows, ends, levels).filter(F.col("_mix_bucket") == F.col("_mix_end"))
    running = W.partitionBy(*levels).orderBy("_mix_place", "_mix_text").rangeBetween(W.unboundedPreceding, W.currentRow)
    inside = inside.withColumn("_mix_sum", start + F.sum("tokens").over(running)).filter(F.col("_mix_sum") <= remainder)
    last = inside.groupBy(*levels).agg(F.max(F.struct("_mix_place", "_mix_text")).alias("_mix_last"))
    cuts = _join(ends, last, levels, "left").select(
        *levels,
        # with no row of the bucket taken, the bucket's own name lies before all of its rows
        F.coalesce(F.col("_mix_last._mix_place"), F.col("_mix_end")).alias("cut_place"),
        F.coalesce(F.col("_mix_last._mix_text"), F.lit("")).alias("cut_text"),
    )
    return keep(_join(plan, cuts, levels, "left"), "mix-cuts")


def take(docs: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with ``_mix_times`` (how often each row is taken) and ``_mix_budget`` (of its leaf)."""
    levels = list(mix.levels)
    own = plan.select(
        *levels, *[F.col(c).alias(f"_mix_{c}") for c in ("budget", "epochs", "cut_place", "cut_text")]
    )
    place, cut = _place(mix, F.col("_mix_epochs"), F.col("doc_id")), F.col("_mix_cut_place")
    more = (place < cut) | ((place == cut) & (_text_hash() <= F.col("_mix_cut_text")))
    joined = _join(docs, own, levels)
    times = F.col("_mix_epochs") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return joined.withColumn("_mix_times", times).drop("_mix_epochs", "_mix_cut_place", "_mix_cut_text")


def selected(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mixture itself: each row as often as it is taken, in the columns of ``docs``."""
    taken = take(docs, plan_mixture(docs, mix), mix).filter(F.col("_mix_times") > 0)
    if mix.max_epochs > 1:
        copies = F.explode(F.sequence(F.lit(1), F.col("_mix_times"))).alias("_mix_copy")
        taken = taken.select(*docs.columns, copies)
    return taken.select(*docs.columns)


# ------------------------------------------------------------------ the query

LEVELS = ("_mix_domain", "lang", "source")
WEIGHTS = {
    "_mix_domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1, "other": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}
DOCUMENT_MIX = Mix(LEVELS, WEIGHTS)


def with_domain(docs: DataFrame) -> DataFrame:
    """The table has no domain; four are made from the number that ends a source's name."""
    number = F.regexp_extract("source", "[0-9]+$", 0)
    known = F.length(number).between(1, 9)
    domain = F.when(known, F.concat(F.lit("d"), (F.when(known, number).cast("int") % 4).cast("string")))
    return docs.withColumn("_mix_domain", F.coalesce(domain, F.lit("other")))


def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(documents(spark, folder))
    rows = take(docs, plan_mixture(docs, DOCUMENT_MIX), DOCUMENT_MIX)
    return rows.select(
        "doc_id",
        F.col("_mix_domain").alias("domain"),
        "lang",
        "source",
        word_tokens(F.col("text")).alias("tokens"),
        F.col("_mix_budget").alias("leaf_budget"),
        F.col("_mix_times").alias("times_taken"),
    )


def _pour_sql(source: str, child: str, parents: list[str], capacity: str, budget: str, weight: str) -> str:
    """One level of budgets: ``source`` is the tree so far, the result adds ``budget_<child>``."""
    keys = [*parents, child]
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    listed = ", ".join(keys)
    return f"""
    SELECT t.*, n.given AS budget_{child} FROM {source} t JOIN (
      SELECT {listed}, CASE WHEN weight = 0 THEN 0 WHEN water IS NULL THEN capacity
                            ELSE least(capacity, CAST(floor(weight * water) AS BIGINT)) END AS given
      FROM (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER ({family}) AS water
            FROM (SELECT *, CASE WHEN rest > 0 THEN CAST(budget - earlier AS DOUBLE) / rest END AS level
                  FROM (SELECT *,
                          coalesce(sum(capacity) OVER ({family} ORDER BY ratio, {child} NULLS FIRST
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
                          sum(weight) OVER ({family} ORDER BY ratio, {child} NULLS FIRST
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
                        FROM (SELECT *, CASE WHEN weight > 0 THEN CAST(capacity AS DOUBLE) / weight
                                             ELSE 'infinity'::DOUBLE END AS ratio
                              FROM (SELECT {listed}, max({capacity}) AS capacity, max({budget}) AS budget,
                                           {weight} AS weight FROM {source} GROUP BY {listed})))))
    ) n ON {' AND '.join(f't.{k} IS NOT DISTINCT FROM n.{k}' for k in keys)}"""


OP1_SQL = f"""
WITH rows0 AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body,
         CASE WHEN length(regexp_extract(source, '[0-9]+$')) BETWEEN 1 AND 9
              THEN 'd' || CAST(CAST(regexp_extract(source, '[0-9]+$') AS INT) % 4 AS VARCHAR) ELSE 'other' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows0 GROUP BY ALL),
tree AS (
  SELECT *, tokens * 4 AS cap3, CAST(sum(tokens) OVER () AS BIGINT) // 2 AS total,
         CAST(sum(tokens * 4) OVER (PARTITION BY domain) AS BIGINT) AS cap1,
         CAST(sum(tokens * 4) OVER (PARTITION BY domain, lang) AS BIGINT) AS cap2 FROM leaves),
tree1 AS ({_pour_sql("tree", "domain", [], "cap1", "total",
    "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END")}),
tree2 AS ({_pour_sql("tree1", "lang", ["domain"], "cap2", "budget_domain",
    "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")}),
tree3 AS ({_pour_sql("tree2", "source", ["domain", "lang"], "cap3", "budget_lang",
    "CASE source WHEN 'src0' THEN 2 ELSE 1 END")}),
plan AS (
  SELECT domain, lang, source, budget_source AS budget,
         CASE WHEN tokens > 0 THEN budget_source // tokens ELSE 0 END AS epochs,
         budget_source - (CASE WHEN tokens > 0 THEN budget_source // tokens ELSE 0 END) * tokens AS remainder FROM tree3),
placed AS (
  SELECT r.*, p.budget, p.epochs, p.remainder,
         md5('mix-' || CAST(p.epochs AS VARCHAR) || '-' || coalesce(CAST(r.doc_id AS VARCHAR), '')) AS place
  FROM rows0 r JOIN plan p ON r.domain IS NOT DISTINCT FROM p.domain AND r.lang IS NOT DISTINCT FROM p.lang
                          AND r.source IS NOT DISTINCT FROM p.source),
summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, md5(body)
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM placed)
SELECT doc_id, domain, lang, source, tokens, budget AS leaf_budget,
       epochs + CASE WHEN remainder > 0 AND running <= remainder THEN 1 ELSE 0 END AS times_taken
FROM summed
"""
