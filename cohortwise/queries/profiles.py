"""Profiles, missing values and cohorts."""

from pyspark.sql import functions as F

from cohortwise.operators import cohort as C
from cohortwise.operators import profile as P
from cohortwise.queries.fixtures import fx_docs, fx_orders, over, table
from cohortwise.queries.registry import query
from cohortwise.sources.tables import read_parquet

_NUMERIC = ["amount", "balance", "klass", "rel_a"]


def _round(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "profile_numeric",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
count(*) - count({c}) AS missing_count, round((count(*) - count({c}))::DOUBLE / count(*) * 100, 4) AS missing_pct FROM fx_orders"""
            for c in _NUMERIC
        ),
    ),
)
def profile_numeric(spark, sf):
    df = P.profile_numeric(fx_orders(spark, sf), _NUMERIC)
    return _round(df, "mean", "std", "q25", "median", "q75", "missing_pct")


_TEXT = ["port", "segment"]


@query(
    "value_counts",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM fx_orders WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in _TEXT
        ),
    ),
)
def value_counts(spark, sf):
    return P.value_counts(fx_orders(spark, sf))


@query(
    "profile_categorical",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS unique_values,
(SELECT {c} FROM fx_orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_frequent,
(SELECT count(*) FROM fx_orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS most_frequent_count,
count(*) - count({c}) AS missing_count, (count(*) - count({c}))::DOUBLE / count(*) * 100 AS missing_pct FROM fx_orders"""
            for c in _TEXT
        ),
    ),
)
def profile_categorical(spark, sf):
    return P.profile_categorical(fx_orders(spark, sf))


@query(
    "dataset_info",
    "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem",
)
def dataset_info(spark, sf):
    return P.dataset_info(read_parquet(spark, f"{sf}/lineitem.parquet"))


_COLUMNS = ["id", "klass", "port", "segment", "amount", "balance", "rel_a", "rel_b", "label"]


@query(
    "missing_by_column",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
(count(*) - count({c}))::DOUBLE / count(*) * 100 AS missing_pct, count({c}) AS present_count,
count({c})::DOUBLE / count(*) * 100 AS present_pct FROM fx_orders"""
            for c in _COLUMNS
        ),
    ),
)
def missing_by_column(spark, sf):
    return P.missing_by_column(fx_orders(spark, sf))


@query(
    "missing_patterns",
    over(
        "fx_orders",
        """SELECT concat('port:', CASE WHEN port IS NULL THEN 'True' ELSE 'False' END, '_amount:',
CASE WHEN amount IS NULL THEN 'True' ELSE 'False' END, '_balance:', CASE WHEN balance IS NULL THEN 'True' ELSE 'False' END) AS pattern,
count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM fx_orders) * 100 AS pct FROM fx_orders GROUP BY 1""",
    ),
)
def missing_patterns(spark, sf):
    return P.missing_patterns(fx_orders(spark, sf))


@query(
    "missing_summary",
    over(
        "fx_orders",
        """WITH c AS (SELECT count(*) AS rows, count(*) - count(port) AS p, count(*) - count(amount) AS a, count(*) - count(balance) AS b,
count(*) FILTER (WHERE port IS NULL OR amount IS NULL OR balance IS NULL) AS w FROM fx_orders)
SELECT p + a + b AS total_missing, rows * 9 AS total_cells, (p + a + b)::DOUBLE / (rows * 9) * 100 AS missing_pct,
CAST(3 AS BIGINT) AS columns_with_missing, CAST(6 AS BIGINT) AS columns_without_missing, w AS rows_with_any_missing,
rows - w AS rows_without_missing, CASE WHEN p >= a AND p >= b THEN 'port' WHEN a >= b THEN 'amount' ELSE 'balance' END AS most_missing_column,
greatest(p, a, b) AS most_missing_count FROM c""",
    ),
)
def missing_summary(spark, sf):
    return P.missing_summary(fx_orders(spark, sf))


@query(
    "cohort_overall",
    over(
        "fx_docs",
        """SELECT count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
sum(label)::DOUBLE / count(*) * 100 AS rate_pct FROM fx_docs""",
    ),
)
def cohort_overall(spark, sf):
    return C.cohort_overall(fx_docs(spark, sf), "label")


_COHORT = """SELECT '{feature}' AS feature, value, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives,
CAST(count(*) - sum(label) AS BIGINT) AS negatives, sum(label)::DOUBLE / count(*) * 100 AS rate_pct,
count(*)::DOUBLE / (SELECT count(*) FROM {view} WHERE ({expr}) IS NOT NULL) * 100 AS share_pct,
(SELECT count(*) FROM {view} WHERE ({expr}) IS NULL) AS missing
FROM (SELECT CAST({expr} AS STRING) AS value, label FROM {view}) WHERE value IS NOT NULL GROUP BY value"""


def _cohort_sql(view, **features):
    return over(view, " UNION ALL ".join(_COHORT.format(feature=f, expr=e, view=view) for f, e in features.items()))


@query("cohort_by_category", _cohort_sql("fx_orders", segment="segment", klass="klass", port="port"))
def cohort_by_category(spark, sf):
    return C.cohort_rates(fx_orders(spark, sf), ["segment", "klass", "port"], "label")


@query("cohort_by_document_source", _cohort_sql("fx_docs", family="family", lang="lang"))
def cohort_by_document_source(spark, sf):
    return C.cohort_rates(fx_docs(spark, sf), ["family", "lang"], "label")


_FIXED = [0, 1000, 2500, 5000, 7500, 9000]
_FIXED_SQL = "CASE " + " ".join(
    f"WHEN balance >= {a} AND balance < {b} THEN 'b{i}'" for i, (a, b) in enumerate(zip(_FIXED, _FIXED[1:]))
) + " END"


@query("cohort_by_fixed_bins", _cohort_sql("fx_orders", balance=_FIXED_SQL))
def cohort_by_fixed_bins(spark, sf):
    return C.cohort_by_bins(fx_orders(spark, sf), "balance", "label", _FIXED, [f"b{i}" for i in range(5)])


_QUARTILE_CTE = """WITH q AS (SELECT min(amount) AS q0, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS q2,
quantile_cont(amount, 0.75) AS q3, max(amount) AS q4 FROM fx_orders),
b AS (SELECT label, amount, CASE WHEN amount >= q0 AND amount <= q1 THEN 'Q1' WHEN amount <= q2 THEN 'Q2' WHEN amount <= q3 THEN 'Q3'
WHEN amount <= q4 THEN 'Q4' END AS grp FROM fx_orders, q)
"""


@query("cohort_by_quantile_bins", over("fx_orders", _QUARTILE_CTE + _COHORT.format(feature="amount", expr="grp", view="b")))
def cohort_by_quantile_bins(spark, sf):
    return C.cohort_by_quartiles(fx_orders(spark, sf), "amount", "label", ["Q1", "Q2", "Q3", "Q4"])


@query(
    "cohort_by_size_class",
    _cohort_sql(
        "fx_orders",
        size_class="""CASE WHEN rel_a + rel_b + 1 = 1 THEN 'Alone' WHEN rel_a + rel_b + 1 <= 3 THEN 'Small Family (2-3)'
WHEN rel_a + rel_b + 1 <= 6 THEN 'Medium Family (4-6)' ELSE 'Large Family (7+)' END""",
    ),
)
def cohort_by_size_class(spark, sf):
    return C.cohort_by_size(fx_orders(spark, sf), "rel_a", "rel_b", "label")


@query(
    "cohort_chart_data",
    over(
        "fx_orders",
        """SELECT segment, count(label) AS count, CAST(sum(label) AS BIGINT) AS sum, sum(label)::DOUBLE / count(label) AS mean
FROM fx_orders GROUP BY segment""",
    ),
)
def cohort_chart_data(spark, sf):
    return C.cohort_chart_data(fx_orders(spark, sf), "segment", "label")


_REPORT = (
    _QUARTILE_CTE.rstrip()
    + """,
n AS (SELECT label, CASE WHEN rel_a + rel_b = 0 THEN 'Alone' WHEN rel_a + rel_b <= 2 THEN 'Small Family (2-3)'
 WHEN rel_a + rel_b <= 5 THEN 'Medium Family (4-6)' ELSE 'Large Family (7+)' END AS size_class FROM fx_orders),
l AS (SELECT 'cohorts' AS section, 'segment' AS feature, segment AS value, label FROM fx_orders
UNION ALL SELECT 'cohorts', 'klass', CAST(klass AS STRING), label FROM fx_orders
UNION ALL SELECT 'cohorts_by_quartiles', 'amount', CASE grp WHEN 'Q1' THEN 'Low Fare (Q1)' WHEN 'Q2' THEN 'Medium-Low Fare (Q2)'
 WHEN 'Q3' THEN 'Medium-High Fare (Q3)' ELSE 'High Fare (Q4)' END, label FROM b WHERE grp IS NOT NULL
UNION ALL SELECT 'cohorts_by_size', 'size_class', size_class, label FROM n)
SELECT section, feature, value, count(*) AS total, sum(label)::DOUBLE / count(*) * 100 AS rate_pct FROM l GROUP BY 1, 2, 3
"""
    + "".join(
        f"""UNION ALL SELECT 'missing', '{c}', 'missing', count(*) - count({c}), (count(*) - count({c}))::DOUBLE / count(*) * 100 FROM fx_orders
"""
        for c in _COLUMNS
    )
)


@query("exploration_report", over("fx_orders", _REPORT))
def exploration_report(spark, sf):
    """The label-rate and missing-value parts of the full report, stacked."""
    report = C.exploration_report(
        fx_orders(spark, sf), "label", categories=["segment", "klass"], quartiles="amount", sizes=("rel_a", "rel_b")
    )
    parts = [
        report[name].select(F.lit(name).alias("section"), "feature", "value", "total", "rate_pct")
        for name in ("cohorts", "cohorts_by_quartiles", "cohorts_by_size")
    ]
    parts.append(
        report["missing_by_column"].select(
            F.lit("missing").alias("section"),
            F.col("column").alias("feature"),
            F.lit("missing").alias("value"),
            F.col("missing_count").alias("total"),
            F.col("missing_pct").alias("rate_pct"),
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "correlation_matrix",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM fx_orders"
            for i, a in enumerate(_NUMERIC)
            for b in _NUMERIC[:i]
        ),
    ),
)
def correlation_matrix(spark, sf):
    return _round(P.correlation_matrix(fx_orders(spark, sf), _NUMERIC), "corr", digits=6)
