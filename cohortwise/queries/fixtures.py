"""Views over the given tables that play the part of labelled tables.

The given tables hold no nulls, so gaps are planted by key arithmetic. Each
view exists twice: as a DataFrame, and as SQL for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions import text as X


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _gap(key: str, every: int, value) -> Column:
    return F.when(F.col(key) % every == 0, F.lit(None)).otherwise(value)


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer: numbers, categories, gaps and a label."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("klass"),
        _gap("o_orderkey", 97, F.col("o_orderstatus")).alias("port"),
        F.col("c_mktsegment").alias("segment"),
        _gap("o_orderkey", 5, F.col("o_totalprice")).alias("amount"),
        _gap("o_orderkey", 11, F.abs("c_acctbal")).alias("balance"),
        (F.col("o_custkey") % 4).cast("int").alias("rel_a"),
        (F.col("o_custkey") % 3).cast("int").alias("rel_b"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
    )


def fx_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items grouped into families by order; filled rows are history."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("id"),
        F.col("l_orderkey").alias("family"),
        F.when(F.col("l_linestatus") == "F", "train").otherwise("score").alias("part"),
        F.when(F.col("l_quantity") <= 10, "Master").when(F.col("l_quantity") <= 30, "Miss").otherwise("Mr").alias("title"),
        F.when(F.col("l_tax") < 0.04, "female").otherwise("male").alias("sex"),
        F.when(F.col("l_discount") < 0.03, 1).when(F.col("l_discount") < 0.07, 2).otherwise(3).alias("klass"),
        F.col("l_linenumber").alias("size"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"),
    )


def fx_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("ptype"),
        F.col("p_size").alias("size"),
        _gap("p_partkey", 4, F.col("p_brand")).alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def fx_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(l, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("family"),
        "lang",
        "n_chars",
        F.col("quality").alias("label"),
        "toxic",
    )


def fx_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders told as passengers: customers are families, with names, tickets and
    cabins spelled the way the feature sets read them."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    letters = F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij")
    title = X.mapped(
        F.col("c_mktsegment"),
        {"AUTOMOBILE": "Mr", "BUILDING": "Mrs", "FURNITURE": "Master", "HOUSEHOLD": "Miss", "MACHINERY": "Col"},
    )
    klass = F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(3))
    woman = F.col("c_nationkey") < 12
    ticket = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderkey").cast("string")).otherwise(
        F.concat(F.col("o_orderstatus"), F.lit("/"), klass.cast("string"), F.lit(" "), F.col("o_orderkey").cast("string"))
    )
    cabin = F.concat(F.substring(F.lit("ABCDEFG"), (F.col("o_custkey") % 7 + 1).cast("int"), F.lit(1)), (F.col("o_custkey") % 130).cast("string"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("PassengerId"),
        F.when(woman, (F.col("o_custkey") % 10 < 7).cast("int")).otherwise((F.col("o_custkey") % 10 < 2).cast("int")).alias("Survived"),
        klass.alias("Pclass"),
        F.concat(letters, F.lit(", "), title, F.lit(". "), F.col("c_name")).alias("Name"),
        F.when(woman, "female").otherwise("male").alias("Sex"),
        _gap("o_orderkey", 5, F.round(F.col("o_totalprice") / 6000, 1)).alias("Age"),
        (F.col("o_custkey") % 4).cast("int").alias("SibSp"),
        (F.col("o_custkey") % 3).cast("int").alias("Parch"),
        ticket.alias("Ticket"),
        _gap("o_orderkey", 11, F.abs("c_acctbal")).alias("Fare"),
        F.when(F.col("o_orderstatus") == "F", cabin).alias("Cabin"),
        _gap("o_orderkey", 97, F.translate("o_orderstatus", "FOP", "CQS")).alias("Embarked"),
    )


# Closed-form scores: per model the multipliers of order key and part key.
MODELS = [("m1", 7, 3), ("m2", 5, 11), ("m3", 13, 2), ("m4", 3, 17), ("m5", 19, 5), ("m6", 11, 23)]


def fx_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of six models for every line item, from arithmetic on its keys."""
    l = table(spark, sf_dir, "lineitem")
    scored = [
        F.struct(
            F.lit(name).alias("model"),
            (((F.col("l_orderkey") * a + F.col("l_partkey") * b + F.col("l_linenumber")) % 101).cast("double") / 100).alias("prob"),
        )
        for name, a, b in MODELS
    ]
    return l.select(
        (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_linestatus").alias("kind"),
        F.explode(F.array(*scored)).alias("s"),
    ).select("id", "s.model", "label", "kind", "s.prob")


SQL = {
    "fx_orders": """
SELECT o_orderkey AS id,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS klass,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderstatus END AS port,
       c_mktsegment AS segment,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE abs(c_acctbal) END AS balance,
       CAST(o_custkey % 4 AS INT) AS rel_a,
       CAST(o_custkey % 3 AS INT) AS rel_b,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_items": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-',
              CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
       l_orderkey AS family,
       CASE WHEN l_linestatus = 'F' THEN 'train' ELSE 'score' END AS part,
       CASE WHEN l_quantity <= 10 THEN 'Master' WHEN l_quantity <= 30 THEN 'Miss' ELSE 'Mr' END AS title,
       CASE WHEN l_tax < 0.04::DOUBLE THEN 'female' ELSE 'male' END AS sex,
       CASE WHEN l_discount < 0.03::DOUBLE THEN 1 WHEN l_discount < 0.07::DOUBLE THEN 2 ELSE 3 END AS klass,
       l_linenumber AS size,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       CAST(l_quantity AS INT) AS quantity,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents
FROM lineitem""",
    "fx_parts": """
SELECT p_partkey AS id, p_name AS name, p_type AS ptype, p_size AS size,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS brand,
       p_retailprice AS price
FROM part""",
    "fx_docs": """
SELECT d.doc_id AS id, d.source AS family, d.lang AS lang, d.n_chars AS n_chars,
       l.quality AS label, l.toxic AS toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "fx_passengers": """
SELECT o_orderkey AS PassengerId,
       CASE WHEN c_nationkey < 12 THEN CAST(o_custkey % 10 < 7 AS INT) ELSE CAST(o_custkey % 10 < 2 AS INT) END AS Survived,
       least(CAST(substr(o_orderpriority, 1, 1) AS INT), 3) AS Pclass,
       translate(CAST(c_custkey AS STRING), '0123456789', 'abcdefghij') AS surname,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Mr' WHEN 'BUILDING' THEN 'Mrs' WHEN 'FURNITURE' THEN 'Master'
         WHEN 'HOUSEHOLD' THEN 'Miss' ELSE 'Col' END AS title,
       CASE WHEN c_nationkey < 12 THEN 'female' ELSE 'male' END AS Sex,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round(o_totalprice / 6000, 1) END AS Age,
       CAST(o_custkey % 4 AS INT) AS SibSp, CAST(o_custkey % 3 AS INT) AS Parch,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE abs(c_acctbal) END AS Fare,
       CASE WHEN o_orderstatus = 'F' THEN concat(substr('ABCDEFG', CAST(o_custkey % 7 + 1 AS INT), 1), CAST(o_custkey % 130 AS STRING)) END AS Cabin,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE translate(o_orderstatus, 'FOP', 'CQS') END AS Embarked
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_scores": """
SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS id, m.model AS model,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_linestatus AS kind,
       CAST((l_orderkey * m.a + l_partkey * m.b + l_linenumber) % 101 AS DOUBLE) / 100 AS prob
FROM lineitem
CROSS JOIN (VALUES """
    + ", ".join(f"('{name}', {a}, {b})" for name, a, b in MODELS)
    + """) m(model, a, b)""",
}


def over(views: str, body: str) -> str:
    """Put the named views in front of a SQL text as common table expressions."""
    ctes = ",\n".join(f"{v} AS ({SQL[v]})" for v in views.split())
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
