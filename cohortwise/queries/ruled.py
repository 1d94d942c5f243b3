"""Rules, overrides and thresholds."""

from pyspark.sql import functions as F

from cohortwise.operators import rules as R
from cohortwise.queries.fixtures import fx_items, fx_orders, fx_scores, over, table
from cohortwise.queries.registry import query
from cohortwise.session import small_table

_UNANIMITY = """SELECT family, count(*) AS members, count(*) FILTER (WHERE title <> 'Mr') AS n_eligible,
sum(label) FILTER (WHERE title <> 'Mr') AS pos FROM fx_items WHERE part = 'train' GROUP BY family"""
_FLAGS = f"""u AS (SELECT family, members, n_eligible, pos::DOUBLE / n_eligible AS rate, CAST(pos = n_eligible AS INT) AS all_live,
CAST(pos = 0 AS INT) AS all_die FROM ({_UNANIMITY}) WHERE n_eligible > 0 AND members >= {{min}}),
s AS (SELECT i.*, coalesce(all_live, 0) AS all_live, coalesce(all_die, 0) AS all_die FROM fx_items i LEFT JOIN u USING (family) WHERE part = 'score')"""


def _unanimity(df, min_members=1):
    train = df.filter(F.col("part") == "train")
    return R.group_unanimity(train, "family", "label", F.col("title") != "Mr", min_members)


def _score_rows(df, min_members=1):
    return R.attach_unanimity(df.filter(F.col("part") == "score"), _unanimity(df, min_members), "family")


def _rules(extended=False):
    return R.passenger_rules(F.col("title"), F.col("sex"), F.col("klass"), F.col("size"), extended)


@query(
    "rule_group_unanimity",
    over(
        "fx_items",
        f"""SELECT family, members, n_eligible, pos::DOUBLE / n_eligible AS rate, CAST(pos = n_eligible AS INT) AS all_live,
CAST(pos = 0 AS INT) AS all_die FROM ({_UNANIMITY}) WHERE n_eligible > 0""",
    ),
)
def rule_group_unanimity(spark, sf):
    return _unanimity(fx_items(spark, sf))


@query(
    "rule_group_unanimity_multi",
    over(
        "fx_items",
        f"""SELECT family, members, n_eligible, pos::DOUBLE / n_eligible AS rate, CAST(pos = n_eligible AS INT) AS all_live,
CAST(pos = 0 AS INT) AS all_die FROM ({_UNANIMITY}) WHERE n_eligible > 0 AND members > 1""",
    ),
)
def rule_group_unanimity_multi(spark, sf):
    return _unanimity(fx_items(spark, sf), min_members=2)


_RULES = """WITH {flags} SELECT id,
CASE WHEN sex = 'female' AND all_die = 1 THEN 0 WHEN title = 'Master' AND all_live = 1 THEN 1 END AS rule_prediction,
CASE WHEN sex = 'female' AND all_die = 1 THEN 'family_dies' WHEN title = 'Master' AND all_live = 1 THEN 'family_lives' END AS rule_name FROM s"""


@query("rules_apply", over("fx_items", _RULES.format(flags=_FLAGS.format(min=1))))
def rules_apply(spark, sf):
    df = R.apply_rules(_score_rows(fx_items(spark, sf)), _rules())
    return df.select("id", "rule_prediction", "rule_name")


_PRECEDENCE = """WITH {flags}, p AS (SELECT id, sex, klass,
CASE WHEN sex = 'female' AND all_die = 1 THEN 'family_dies' WHEN title = 'Master' AND all_live = 1 THEN 'family_lives'
WHEN title = 'Master' AND size > 1 THEN 'boy_with_company' WHEN sex = 'female' AND klass = 1 AND size > 1 THEN 'first_class_woman' END AS rule_name FROM s)
"""


@query(
    "rules_apply_precedence",
    over(
        "fx_items",
        _PRECEDENCE.format(flags=_FLAGS.format(min=2))
        + "SELECT id, CASE WHEN rule_name = 'family_dies' THEN 0 WHEN rule_name IS NOT NULL THEN 1 END AS rule_prediction, rule_name FROM p",
    ),
)
def rules_apply_precedence(spark, sf):
    df = R.apply_rules(_score_rows(fx_items(spark, sf), 2), _rules(extended=True))
    return df.select("id", "rule_prediction", "rule_name")


@query(
    "rules_override_table",
    over(
        "fx_orders",
        """WITH o AS (SELECT o_orderkey AS id FROM orders WHERE o_totalprice > 400000 AND o_orderpriority = '1-URGENT')
SELECT id, CASE WHEN id IN (SELECT id FROM o) THEN 0 WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS prediction FROM fx_orders""",
    ),
)
def rules_override_table(spark, sf):
    orders = table(spark, sf, "orders")
    listed = orders.filter((F.col("o_totalprice") > 400000) & (F.col("o_orderpriority") == "1-URGENT"))
    overrides = listed.select(F.col("o_orderkey").alias("id"), F.lit(0).alias("value"))
    df = fx_orders(spark, sf).withColumn("prediction", R.baseline("segment", "BUILDING"))
    return R.override(df, overrides, "id", "value", "prediction").select("id", "prediction")


@query("rules_baseline", over("fx_items", "SELECT id, CASE WHEN sex = 'female' THEN 1 ELSE 0 END AS prediction FROM fx_items"))
def rules_baseline(spark, sf):
    return fx_items(spark, sf).select("id", R.baseline("sex", "female").alias("prediction"))


@query(
    "rules_conservative",
    over(
        "fx_items",
        f"""WITH {_FLAGS.format(min=1)}
SELECT id, CASE WHEN sex = 'male' AND klass = 3 AND size = 1 THEN 0 WHEN sex = 'female' AND klass = 1 AND size > 1 THEN 1
WHEN family IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 0
WHEN sex = 'female' AND all_die = 1 THEN 0 WHEN title = 'Master' AND all_live = 1 THEN 1
WHEN sex = 'female' THEN 1 ELSE 0 END AS prediction FROM s""",
    ),
)
def rules_conservative(spark, sf):
    """Baseline, family rules, override table, then the last-word rules."""
    rows = _score_rows(fx_items(spark, sf))
    ruled = R.apply_rules(rows, _rules(), "prediction", "rule", initial=R.baseline("sex", "female"))
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    overrides = urgent.select(F.col("o_orderkey").alias("family"), F.lit(0).alias("value"))
    listed = R.override(ruled, overrides, "family", "value", "prediction")
    last = R.closing_rules(F.col("sex"), F.col("klass"), F.col("size") - 1)
    final = R.apply_rules(listed, last, "final", "last_rule", initial=F.col("prediction"))
    return final.select("id", F.col("final").alias("prediction"))


@query(
    "combine_predictions",
    over(
        "fx_items",
        _PRECEDENCE.format(flags=_FLAGS.format(min=1))
        + """, m AS (SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
max(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS model FROM lineitem WHERE l_quantity > 20 GROUP BY 1)
SELECT id, coalesce(CASE WHEN rule_name = 'family_dies' THEN 0 WHEN rule_name = 'family_lives' THEN 1 END, model,
CASE WHEN sex = 'female' THEN 1 ELSE 0 END) AS prediction FROM p LEFT JOIN m USING (id)""",
    ),
)
def combine_predictions(spark, sf):
    """Rule where set, else the model's prediction, else the baseline."""
    ruled = R.apply_rules(_score_rows(fx_items(spark, sf)), _rules())
    l = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 20)
    keys = [F.col(k).cast("string") for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    model = l.groupBy(F.concat_ws("-", *keys).alias("id")).agg(
        F.max(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("model")
    )
    combined = R.combine(F.col("rule_prediction"), F.col("model"), R.baseline("sex", "female"))
    return ruled.join(model, "id", "left").select("id", combined.alias("prediction"))


@query(
    "threshold_by_cohort",
    over(
        "fx_scores",
        """SELECT id, model, CASE WHEN prob > CASE WHEN kind = 'F' THEN 0.4::DOUBLE WHEN kind = 'O' THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END THEN 1 ELSE 0 END AS prediction
FROM fx_scores""",
    ),
)
def threshold_by_cohort(spark, sf):
    thresholds = small_table(spark, [("O", 0.6), ("F", 0.4)], "kind string, threshold double")
    df = R.decide(fx_scores(spark, sf), "prob", thresholds, "kind")
    return df.select("id", "model", "prediction")


@query(
    "threshold_single",
    over("fx_scores", "SELECT id, model, CASE WHEN prob > 0.49::DOUBLE THEN 1 ELSE 0 END AS prediction FROM fx_scores"),
)
def threshold_single(spark, sf):
    return R.decide(fx_scores(spark, sf), "prob", 0.49).select("id", "model", "prediction")


@query(
    "rules_audit",
    over(
        "fx_items",
        _PRECEDENCE.format(flags=_FLAGS.format(min=1))
        + """SELECT rule_name, count(*) AS n, CASE WHEN rule_name = 'family_dies' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS mean_prediction
FROM p WHERE rule_name IS NOT NULL GROUP BY rule_name""",
    ),
)
def rules_audit(spark, sf):
    return R.audit(R.apply_rules(_score_rows(fx_items(spark, sf)), _rules(extended=True)))


@query(
    "rules_explain",
    over(
        "fx_items",
        f"""WITH u AS (SELECT family, members, n_eligible, pos::DOUBLE / n_eligible AS rate FROM ({_UNANIMITY}) WHERE n_eligible > 0),
a AS (SELECT DISTINCT o_orderkey AS id FROM orders), r AS (SELECT DISTINCT family AS id, family FROM fx_items WHERE part = 'score')
SELECT a.id, CASE WHEN r.id IS NULL THEN 0 ELSE 1 END AS found, r.family, coalesce(members, 0) AS members, coalesce(n_eligible, 0) AS n_eligible, rate,
CASE WHEN rate = 1 THEN 'LIVE' WHEN rate = 0 THEN 'DIE' WHEN rate IS NOT NULL THEN 'mixed' ELSE 'none' END AS verdict
FROM a LEFT JOIN r ON a.id = r.id LEFT JOIN u ON r.family = u.family""",
    ),
)
def rules_explain(spark, sf):
    """For every order: is it among the rows to score, and what does its group say."""
    items = fx_items(spark, sf)
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    rows = items.filter(F.col("part") == "score").select(F.col("family").alias("id"), "family").distinct()
    return R.explain(ids, rows, _unanimity(items), "id", "family")
