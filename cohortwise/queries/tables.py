"""Sources, validation and sinks."""

from pyspark.sql import functions as F

from cohortwise.operators import validate as V
from cohortwise.queries.fixtures import fx_items, fx_orders, fx_scores, over, table
from cohortwise.queries.registry import query
from cohortwise.session import scratch_path
from cohortwise.sources.tables import prediction_table, read_csv, read_predictions, write_predictions

ORDER_RULES = V.TableRules(
    key="id",
    required=["id", "klass", "port", "segment", "amount", "balance", "rel_a", "rel_b", "label"],
    domains={"label": [0, 1], "klass": [1, 2, 3], "segment": ["AUTOMOBILE", "BUILDING", "MACHINERY"], "port": ["F", "O", "P"]},
    numeric=["amount", "balance", "segment"],
    expected_rows=1000,
)


@query(
    "src_scan_count",
    """SELECT count(*) AS n, count(o_orderkey) AS n_keys, CAST(sum(o_custkey) AS BIGINT) AS key_sum FROM orders""",
)
def src_scan_count(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-csv")
    kept = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    kept.write.option("header", True).csv(path)
    back = read_csv(spark, path, kept.schema)
    return back.agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("n_keys"), F.sum("o_custkey").alias("key_sum")
    )


@query(
    "val_report",
    over(
        "fx_orders",
        """
WITH c AS (SELECT count(*) AS rows,
  count(*) FILTER (WHERE klass IS NOT NULL AND klass NOT IN (1,2,3)) AS k,
  count(*) FILTER (WHERE label IS NOT NULL AND label NOT IN (0,1)) AS l,
  count(*) FILTER (WHERE segment IS NOT NULL AND segment NOT IN ('AUTOMOBILE','BUILDING','MACHINERY')) AS s,
  count(*) FILTER (WHERE port IS NOT NULL AND port NOT IN ('F','O','P')) AS p,
  count(*) FILTER (WHERE segment IS NOT NULL AND TRY_CAST(segment AS DOUBLE) IS NULL) AS ns FROM fx_orders)
SELECT 'domain:klass' AS "check", k AS violations FROM c
UNION ALL SELECT 'domain:label', l FROM c UNION ALL SELECT 'domain:segment', s FROM c
UNION ALL SELECT 'domain:port', p FROM c
UNION ALL SELECT 'numeric:amount', 0 FROM c UNION ALL SELECT 'numeric:balance', 0 FROM c
UNION ALL SELECT 'numeric:segment', ns FROM c
UNION ALL SELECT 'empty', CASE WHEN rows = 0 THEN 1 ELSE 0 END FROM c
UNION ALL SELECT 'missing_columns', 0 FROM c
UNION ALL SELECT 'row_count', abs(rows - 1000) FROM c
UNION ALL SELECT 'duplicate_keys', (SELECT count(*) FROM (SELECT id FROM fx_orders GROUP BY id HAVING count(*) > 1)) FROM c""",
    ),
)
def val_report(spark, sf):
    return V.validation_report(fx_orders(spark, sf), ORDER_RULES)


@query(
    "val_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def val_duplicate_keys(spark, sf):
    return V.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "val_domain_violations",
    over(
        "fx_orders",
        """
SELECT 'klass' AS "column", count(*) FILTER (WHERE klass IS NOT NULL AND klass NOT IN (1,2,3)) AS violations FROM fx_orders
UNION ALL SELECT 'segment', count(*) FILTER (WHERE segment IS NOT NULL AND segment NOT IN ('AUTOMOBILE','BUILDING')) FROM fx_orders
UNION ALL SELECT 'port', count(*) FILTER (WHERE port IS NOT NULL AND port NOT IN ('F','O')) FROM fx_orders""",
    ),
)
def val_domain_violations(spark, sf):
    domains = {"klass": [1, 2, 3], "segment": ["AUTOMOBILE", "BUILDING"], "port": ["F", "O"]}
    return V.domain_violations(fx_orders(spark, sf), domains)


@query(
    "val_numeric_coercion",
    """
SELECT 'p_brand' AS "column", count(*) FILTER (WHERE p_brand IS NOT NULL AND TRY_CAST(p_brand AS DOUBLE) IS NULL) AS violations FROM part
UNION ALL SELECT 'p_size', count(*) FILTER (WHERE p_size IS NOT NULL AND TRY_CAST(p_size AS DOUBLE) IS NULL) FROM part
UNION ALL SELECT 'brand_number', count(*) FILTER (WHERE TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) IS NULL) FROM part""",
)
def val_numeric_coercion(spark, sf):
    part = table(spark, sf, "part").withColumn("brand_number", F.replace("p_brand", F.lit("Brand#1"), F.lit("")))
    return V.coercion_failures(part, ["p_brand", "p_size", "brand_number"])


_COLUMNS = ["id", "klass", "port", "segment", "amount", "balance", "rel_a", "rel_b", "label"]


@query(
    "info_null_counts",
    over(
        "fx_orders",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM fx_orders" for c in _COLUMNS
        ),
    ),
)
def info_null_counts(spark, sf):
    return V.null_counts(fx_orders(spark, sf))


_PREDICTED = "SELECT id, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS prediction FROM fx_orders"


def _predicted(spark, sf):
    df = fx_orders(spark, sf).withColumn("p", F.when(F.col("segment") == "BUILDING", 1).otherwise(0))
    return prediction_table(df, "id", "p", "prediction")


@query(
    "sink_roundtrip",
    over("fx_orders", f"SELECT CAST(id AS STRING) AS id, CAST(prediction AS STRING) AS prediction FROM ({_PREDICTED})"),
)
def sink_roundtrip(spark, sf):
    path = write_predictions(_predicted(spark, sf), scratch_path(spark, "predictions"))
    return read_predictions(spark, path)


_CHECK_SQL = """
WITH p AS ({source}),
c AS (SELECT count(*) AS rows, count(*) FILTER (WHERE id IS NULL OR prediction IS NULL) AS miss,
  count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0,1)) AS bad,
  (SELECT count(*) FROM (SELECT id FROM p GROUP BY id HAVING count(*) > 1)) AS dup FROM p),
d AS (SELECT 'columns' AS "check", CAST(0 AS BIGINT) AS detail FROM c
UNION ALL SELECT 'row_count', abs(rows - {expected}) FROM c
UNION ALL SELECT 'key_numeric', 0 FROM c
UNION ALL SELECT 'unique_keys', dup FROM c
UNION ALL SELECT 'no_missing_values', miss FROM c
UNION ALL SELECT 'binary_predictions', bad FROM c
UNION ALL SELECT 'compliant', abs(rows - {expected}) + dup + miss + bad FROM c)
SELECT "check", detail = 0 AS passed, detail FROM d"""


@query("sink_validate", over("fx_orders", _CHECK_SQL.format(source=_PREDICTED, expected="(SELECT count(*) FROM orders)")))
def sink_validate(spark, sf):
    path = write_predictions(_predicted(spark, sf), scratch_path(spark, "predictions"))
    rows = table(spark, sf, "orders").count()
    return V.output_checks(read_predictions(spark, path), "id", "prediction", rows)


_FAULTY = """SELECT CAST(l_orderkey AS BIGINT) AS id,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN l_quantity > 45 THEN 2 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS prediction
FROM lineitem"""


def _faulty(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_orderkey") % 89 == 0, F.lit(None))
        .when(F.col("l_quantity") > 45, 2)
        .when(F.col("l_returnflag") == "R", 1)
        .otherwise(0)
        .alias("prediction"),
    )


@query("compliance_report", _CHECK_SQL.format(source=_FAULTY, expected="1000").strip())
def compliance_report(spark, sf):
    return V.output_checks(_faulty(spark, sf), "id", "prediction", 1000)


@query(
    "compliance_offenders",
    f"""WITH p AS ({_FAULTY})
SELECT CAST(id AS STRING) AS key, 'no_missing_values' AS "check" FROM p WHERE prediction IS NULL
UNION ALL SELECT CAST(id AS STRING), 'binary_predictions' FROM p WHERE prediction NOT IN (0, 1)
UNION ALL SELECT CAST(id AS STRING), 'unique_keys' FROM p GROUP BY id HAVING count(*) > 1""",
)
def compliance_offenders(spark, sf):
    return V.output_offenders(_faulty(spark, sf), "id", "prediction")


_FILE_SQL = f"""WITH t AS ({_CHECK_SQL.format(source=_PREDICTED, expected="1000")}),
e AS (SELECT 'file_exists' AS "check", TRUE AS passed, CAST(0 AS BIGINT) AS detail UNION ALL SELECT 'csv_format', TRUE, 0
UNION ALL SELECT 'readable', count(*) > 0, CAST(count(*) = 0 AS BIGINT) FROM fx_orders UNION ALL SELECT * FROM t WHERE "check" <> 'compliant')
SELECT * FROM e UNION ALL SELECT 'compliant', bool_and(passed), CAST(sum(detail) AS BIGINT) FROM e"""


@query("sink_file_checks", over("fx_orders", _FILE_SQL))
def sink_file_checks(spark, sf):
    """A written file with another number of rows than wanted."""
    path = write_predictions(_predicted(spark, sf), scratch_path(spark, "predictions") + ".csv")
    return V.file_checks(spark, path, "id", "prediction", 1000)


_DETAILS = """WITH p AS ({source}), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE id IS NULL) AS k, count(*) FILTER (WHERE prediction IS NULL) AS l,
  count(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0, 1)) AS bad, count(*) FILTER (WHERE prediction = 1) AS ones FROM p),
d AS (SELECT 'missing' AS part, 'id' AS item, k::DOUBLE AS value FROM c WHERE k > 0 UNION ALL SELECT 'missing', 'prediction', l FROM c WHERE l > 0
UNION ALL SELECT 'summary', 'total', n FROM c WHERE bad = 0 UNION ALL SELECT 'summary', 'positives', ones FROM c WHERE bad = 0
UNION ALL SELECT 'summary', 'negatives', n - ones FROM c WHERE bad = 0 UNION ALL SELECT 'summary', 'positive_rate', ones / n FROM c WHERE bad = 0
UNION ALL SELECT 'invalid', CAST(prediction AS VARCHAR), count(*) FROM p WHERE prediction NOT IN (0, 1) GROUP BY prediction
UNION ALL SELECT 'repeated', CAST(id AS VARCHAR), count(*) FROM p WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
SELECT part, item, round(value, 8) AS value FROM d"""


def _details(df):
    return V.compliance_details(df, "id", "prediction").withColumn("value", F.round("value", 8))


@query("compliance_details", _DETAILS.format(source=_FAULTY))
def compliance_details(spark, sf):
    """What stands behind a report that fails."""
    return _details(_faulty(spark, sf))


@query("compliance_summary", over("fx_orders", _DETAILS.format(source=_PREDICTED)))
def compliance_summary(spark, sf):
    """The same of a table that passes."""
    return _details(_predicted(spark, sf))


@query(
    "val_predictions",
    over(
        "fx_scores",
        """SELECT count(*) FILTER (WHERE p IS NULL) AS missing, count(*) FILTER (WHERE p NOT IN (0, 1)) AS not_binary,
CAST(abs(count(*) - 1000) AS BIGINT) AS row_gap
FROM (SELECT CASE WHEN prob = 0.25 THEN NULL WHEN prob > 0.95 THEN 2 WHEN prob > 0.5 THEN 1 ELSE 0 END AS p FROM fx_scores)""",
    ),
)
def val_predictions(spark, sf):
    p = F.col("prob")
    value = F.when(p == 0.25, F.lit(None)).when(p > 0.95, 2).when(p > 0.5, 1).otherwise(0)
    return V.prediction_checks(fx_scores(spark, sf).withColumn("p", value), "p", 1000)


@query(
    "prediction_summary",
    over(
        "fx_items",
        """SELECT count(*) AS total, count(*) FILTER (WHERE sex = 'female') AS positives,
count(*) FILTER (WHERE sex <> 'female') AS negatives,
CAST(count(*) FILTER (WHERE sex = 'female') AS DOUBLE) / count(*) AS positive_rate FROM fx_items""",
    ),
)
def prediction_summary(spark, sf):
    df = fx_items(spark, sf).withColumn("p", F.when(F.col("sex") == "female", 1).otherwise(0))
    return V.prediction_summary(df, "p")
