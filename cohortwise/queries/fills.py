"""Filling gaps."""

from pyspark.sql import functions as F

from cohortwise.operators import impute as I
from cohortwise.operators.cohort import cohort_rates
from cohortwise.operators.quantiles import grouped_median
from cohortwise.queries.fixtures import fx_orders, fx_parts, over
from cohortwise.queries.registry import query


def _round(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "fit_group_median",
    over(
        "fx_orders",
        """SELECT klass, segment, round(quantile_cont(amount, 0.5), 4) AS median, count(amount) AS n FROM fx_orders
WHERE amount IS NOT NULL GROUP BY klass, segment""",
    ),
)
def fit_group_median(spark, sf):
    return _round(grouped_median(fx_orders(spark, sf), ["klass", "segment"], "amount"), "median")


@query(
    "fit_mode",
    over("fx_orders", "SELECT port AS mode, count(*) AS n FROM fx_orders WHERE port IS NOT NULL GROUP BY port ORDER BY n DESC, port LIMIT 1"),
)
def fit_mode(spark, sf):
    return I.mode_table(fx_orders(spark, sf), "port")


@query(
    "impute_group_then_global",
    over(
        "fx_orders",
        """WITH g AS (SELECT klass, port, quantile_cont(amount, 0.5) AS m FROM fx_orders WHERE port IS NOT NULL GROUP BY 1, 2),
s AS (SELECT o.id, coalesce(o.amount, g.m) AS amount FROM fx_orders o LEFT JOIN g ON o.klass = g.klass AND o.port = g.port)
SELECT id, round(coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM s)), 4) AS amount FROM s""",
    ),
)
def impute_group_then_global(spark, sf):
    df = fx_orders(spark, sf)
    imputer = I.MedianImputer("amount", [["klass", "port"], []], staged=True).fit(df)
    return _round(imputer.transform(df).select("id", "amount"), "amount")


_HIERARCHY = """WITH g AS (SELECT klass, port, quantile_cont(balance, 0.5) AS m FROM fx_orders WHERE port IS NOT NULL GROUP BY 1, 2),
s AS (SELECT o.*, coalesce(o.balance, g.m) AS b1 FROM fx_orders o LEFT JOIN g ON o.klass = g.klass AND o.port = g.port),
k AS (SELECT klass, quantile_cont(b1, 0.5) AS m FROM s GROUP BY klass)
"""


@query(
    "impute_group_hierarchy",
    over("fx_orders", _HIERARCHY + "SELECT id, round(coalesce(b1, k.m), 4) AS balance FROM s LEFT JOIN k ON s.klass = k.klass"),
)
def impute_group_hierarchy(spark, sf):
    df = fx_orders(spark, sf)
    imputer = I.MedianImputer("balance", [["klass", "port"], ["klass"]], staged=True).fit(df)
    return _round(imputer.transform(df).select("id", "balance"), "balance")


_MODE = "(SELECT port FROM fx_orders WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)"


@query("impute_mode", over("fx_orders", f"SELECT id, coalesce(port, {_MODE}) AS port FROM fx_orders"))
def impute_mode(spark, sf):
    df = fx_orders(spark, sf)
    return I.ModeImputer("port").fit(df).transform(df).select("id", "port")


@query(
    "impute_all",
    over(
        "fx_orders",
        _HIERARCHY.rstrip()
        + f""",
a AS (SELECT klass, segment, quantile_cont(amount, 0.5) AS m FROM fx_orders GROUP BY 1, 2)
SELECT s.id, round(coalesce(s.amount, a.m), 4) AS amount, round(coalesce(b1, k.m), 4) AS balance, coalesce(s.port, {_MODE}) AS port
FROM s LEFT JOIN k ON s.klass = k.klass LEFT JOIN a ON s.klass = a.klass AND s.segment = a.segment""",
    ),
)
def impute_all(spark, sf):
    df = fx_orders(spark, sf)
    filling = I.GapFilling(age="amount", fare="balance", port="port", klass="klass", sex="segment").fit(df)
    return _round(filling.transform(df).select("id", "amount", "balance", "port"), "amount", "balance")


@query(
    "fit_median_grouping_sets",
    over(
        "fx_orders",
        """WITH f AS (SELECT * FROM fx_orders WHERE amount IS NOT NULL)
SELECT 0 AS level, port, klass, segment, round(quantile_cont(amount, 0.5), 4) AS median, count(*) AS n FROM f WHERE port IS NOT NULL GROUP BY 2, 3, 4
UNION ALL SELECT 1, NULL, klass, segment, round(quantile_cont(amount, 0.5), 4), count(*) FROM f GROUP BY klass, segment
UNION ALL SELECT 2, NULL, NULL, NULL, round(quantile_cont(amount, 0.5), 4), count(*) FROM f""",
    ),
)
def fit_median_grouping_sets(spark, sf):
    levels = [["port", "klass", "segment"], ["klass", "segment"], []]
    return _round(I.medians_by_levels(fx_orders(spark, sf), "amount", levels), "median")


@query(
    "impute_three_level",
    over(
        "fx_orders",
        """WITH a AS (SELECT port, klass, segment, quantile_cont(amount, 0.5) AS m FROM fx_orders WHERE port IS NOT NULL GROUP BY 1, 2, 3),
b AS (SELECT klass, segment, quantile_cont(amount, 0.5) AS m FROM fx_orders GROUP BY 1, 2),
c AS (SELECT quantile_cont(amount, 0.5) AS m FROM fx_orders)
SELECT o.id, round(coalesce(o.amount, a.m, b.m, c.m), 4) AS amount FROM fx_orders o
LEFT JOIN a ON o.port = a.port AND o.klass = a.klass AND o.segment = a.segment
LEFT JOIN b ON o.klass = b.klass AND o.segment = b.segment CROSS JOIN c""",
    ),
)
def impute_three_level(spark, sf):
    df = fx_orders(spark, sf)
    imputer = I.MedianImputer("amount", [["port", "klass", "segment"], ["klass", "segment"], []]).fit(df)
    return _round(imputer.transform(df).select("id", "amount"), "amount")


@query(
    "impute_nearest_median",
    over(
        "fx_orders",
        f"""WITH g AS (SELECT klass, port, quantile_cont(amount, 0.5) AS m FROM fx_orders WHERE port IN ('F', 'O', 'P') AND amount IS NOT NULL GROUP BY 1, 2),
r AS (SELECT o.id, g.port, row_number() OVER (PARTITION BY o.id ORDER BY abs(g.m - o.amount) NULLS FIRST, g.port) AS rn
FROM fx_orders o JOIN g ON o.klass = g.klass WHERE o.port IS NULL)
SELECT o.id, coalesce(o.port, r.port, {_MODE}) AS port FROM fx_orders o LEFT JOIN r ON o.id = r.id AND r.rn = 1""",
    ),
)
def impute_nearest_median(spark, sf):
    df = fx_orders(spark, sf)
    imputer = I.NearestMedianImputer("port", "klass", "amount", ["F", "O", "P"]).fit(df)
    return imputer.transform(df).select("id", "port")


@query(
    "impute_constant_map",
    over(
        "fx_orders",
        """SELECT id, coalesce(amount, CASE segment WHEN 'AUTOMOBILE' THEN 32.32 WHEN 'BUILDING' THEN 21.68 WHEN 'FURNITURE' THEN 35.86
WHEN 'HOUSEHOLD' THEN 4.57 END::DOUBLE) AS amount FROM fx_orders""",
    ),
)
def impute_constant_map(spark, sf):
    values = {"AUTOMOBILE": 32.32, "BUILDING": 21.68, "FURNITURE": 35.86, "HOUSEHOLD": 4.57}
    return I.fill_from_map(fx_orders(spark, sf), "amount", "segment", values).select("id", "amount")


@query(
    "impute_simple",
    over(
        "fx_orders fx_parts",
        f"""SELECT id, round(coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM fx_orders)), 4) AS amount,
round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM fx_orders)), 4) AS balance, coalesce(port, {_MODE}) AS port FROM fx_orders""",
    ),
)
def impute_simple(spark, sf):
    df = fx_orders(spark, sf)
    imputer = I.SimpleImputer(median=["amount", "balance"], mode=["port"]).fit(df)
    return _round(imputer.transform(df).select("id", "amount", "balance", "port"), "amount", "balance")


@query("impute_constant", over("fx_parts", "SELECT id, coalesce(brand, 'S') AS brand FROM fx_parts"))
def impute_constant(spark, sf):
    df = fx_parts(spark, sf)
    return I.SimpleImputer(constant={"brand": "S"}).fit(df).transform(df).select("id", "brand")


@query(
    "fill_zero", over("fx_orders", "SELECT id, coalesce(amount, 0) AS amount, coalesce(balance, 0) AS balance, port FROM fx_orders")
)
def fill_zero(spark, sf):
    return I.fill_zero(fx_orders(spark, sf), ["amount", "balance"]).select("id", "amount", "balance", "port")


@query(
    "filled_cohort_rates",
    over(
        "fx_orders",
        """WITH m AS (SELECT klass, segment, quantile_cont(amount, 0.5) AS m FROM fx_orders GROUP BY 1, 2),
f AS (SELECT o.*, round(coalesce(o.amount, m.m) * 100)::BIGINT AS cents FROM fx_orders o LEFT JOIN m ON o.klass = m.klass AND o.segment = m.segment),
p AS (SELECT label, CASE WHEN cents < 10000000 THEN 'low' WHEN cents < 30000000 THEN 'mid' ELSE 'high' END AS amount_band, segment FROM f),
l AS (SELECT 'amount_band' AS feature, amount_band AS value, label FROM p UNION ALL SELECT 'segment', segment, label FROM p)
SELECT feature, value, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
sum(label)::DOUBLE / count(*) * 100 AS rate_pct, count(*)::DOUBLE / (SELECT count(*) FROM p) * 100 AS share_pct, 0 AS missing
FROM l GROUP BY feature, value""",
    ),
)
def filled_cohort_rates(spark, sf):
    df = fx_orders(spark, sf)
    filled = I.MedianImputer("amount", [["klass", "segment"], []], staged=True).fit(df).transform(df)
    cents = F.round(F.col("amount") * 100)
    band = F.when(cents < 10000000, "low").when(cents < 30000000, "mid").otherwise("high")
    return cohort_rates(filled, {"amount_band": band, "segment": F.col("segment")}, "label")
