"""Encoding, scaling and feature scores."""

from pyspark.sql import functions as F

from cohortwise.operators import encode as E
from cohortwise.operators import scale as S
from cohortwise.operators import target_encode as T
from cohortwise.operators.information import neighbour_information
from cohortwise.operators.joins import join_with_default, keep_members, mark_members
from cohortwise.operators.split import assign_folds
from cohortwise.queries.fixtures import fx_docs, fx_items, fx_orders, over, table
from cohortwise.queries.registry import query

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _onehot_sql(column, values):
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{column}_{v}\"" for v in values)


@query(
    "onehot_fixed",
    over("fx_orders", f"SELECT id, {_onehot_sql('port', ['F', 'O', 'P'])}, {_onehot_sql('segment', ['BUILDING', 'MACHINERY'])} FROM fx_orders"),
)
def onehot_fixed(spark, sf):
    df = E.onehot_fixed(fx_orders(spark, sf), {"port": ["F", "O", "P"], "segment": ["BUILDING", "MACHINERY"]})
    return df.select("id", "port_F", "port_O", "port_P", "segment_BUILDING", "segment_MACHINERY")


@query(
    "onehot_aligned",
    over(
        "fx_orders",
        """SELECT id, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS "segment_BUILDING",
CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END AS "segment_MACHINERY" FROM fx_orders""",
    ),
)
def onehot_aligned(spark, sf):
    """Fitted on two segments, applied to all: other segments are 0 everywhere."""
    df = fx_orders(spark, sf)
    encoder = E.OneHot(["segment"]).fit(df.filter(F.col("segment").isin("BUILDING", "MACHINERY")))
    return encoder.transform(df).select("id", *encoder.names)


@query(
    "onehot_drop_first",
    over("fx_orders", f"SELECT id, {_onehot_sql('segment', _SEGMENTS[1:])}, {_onehot_sql('port', ['O', 'P'])} FROM fx_orders"),
)
def onehot_drop_first(spark, sf):
    df = fx_orders(spark, sf)
    encoder = E.OneHot(["segment", "port"], drop_first=True).fit(df)
    return encoder.transform(df).select("id", *encoder.names)


@query(
    "label_encode",
    """WITH v AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) - 1 AS INT) AS code
FROM (SELECT DISTINCT p_name FROM part WHERE p_type <> 'ECONOMY'))
SELECT p_partkey, coalesce(code, -1) AS p_name_encoded FROM part LEFT JOIN v USING (p_name)""",
)
def label_encode(spark, sf):
    part = table(spark, sf, "part")
    codes = E.LabelCodes(["p_name"]).fit(part.filter(F.col("p_type") != "ECONOMY"))
    return codes.transform(part).select("p_partkey", "p_name_encoded")


@query(
    "label_encode_large",
    """WITH v AS (SELECT c, CAST(row_number() OVER (ORDER BY c) - 1 AS INT) AS code
FROM (SELECT DISTINCT CAST(l_orderkey AS STRING) AS c FROM lineitem WHERE l_linestatus = 'F'))
SELECT l_orderkey, l_partkey, coalesce(code, -1) AS l_orderkey_encoded FROM lineitem LEFT JOIN v ON CAST(l_orderkey AS STRING) = c""",
)
def label_encode_large(spark, sf):
    l = table(spark, sf, "lineitem")
    codes = E.LabelCodes(["l_orderkey"]).fit(l.filter(F.col("l_linestatus") == "F"))
    return codes.transform(l).select("l_orderkey", "l_partkey", "l_orderkey_encoded")


@query(
    "rare_group",
    """WITH c AS (SELECT l_suppkey, l_partkey, concat(CAST(l_partkey AS STRING), '/', l_returnflag) AS item FROM lineitem),
n AS (SELECT item, count(*) AS n FROM c GROUP BY item)
SELECT l_suppkey, l_partkey, CASE WHEN n < 10 THEN 'Rare' ELSE item END AS item FROM c JOIN n USING (item)""",
)
def rare_group(spark, sf):
    l = table(spark, sf, "lineitem")
    df = l.select("l_suppkey", "l_partkey", F.concat(F.col("l_partkey").cast("string"), F.lit("/"), "l_returnflag").alias("item"))
    return E.RareGroups(["item"]).fit(df).transform(df)


@query("align_columns", over("fx_orders", "SELECT label, 0 AS unseen, id, amount FROM fx_orders"))
def align_columns(spark, sf):
    return E.align_columns(fx_orders(spark, sf), ["label", "unseen", "id", "amount"])


@query(
    "standardize",
    over(
        "fx_orders",
        """SELECT id, round((amount - (SELECT avg(amount) FROM fx_orders)) / (SELECT stddev_pop(amount) FROM fx_orders), 8) AS amount,
round((balance - (SELECT avg(balance) FROM fx_orders)) / (SELECT stddev_pop(balance) FROM fx_orders), 8) AS balance FROM fx_orders""",
    ),
)
def standardize(spark, sf):
    df = fx_orders(spark, sf)
    scaled = S.Standardizer(["amount", "balance"]).fit(df).transform(df)
    return scaled.select("id", F.round("amount", 8).alias("amount"), F.round("balance", 8).alias("balance"))


_ALL = ["quantity", "price_cents", "size", "klass", "label"]


@query(
    "standardize_all",
    over(
        "fx_items",
        "SELECT id, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM fx_items)) / (SELECT stddev_pop({c}) FROM fx_items), 8) AS {c}" for c in _ALL
        )
        + " FROM fx_items",
    ),
)
def standardize_all(spark, sf):
    df = fx_items(spark, sf).select("id", *_ALL)
    scaled = S.Standardizer().fit(df).transform(df)
    return scaled.select("id", *[F.round(c, 8).alias(c) for c in _ALL])


_FEATURES = ["amount", "balance", "klass", "rel_a"]


@query(
    "anova_f",
    over(
        "fx_orders",
        "WITH l AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, label AS y, {c}::DOUBLE AS x FROM fx_orders WHERE {c} IS NOT NULL" for c in _FEATURES)
        + """), g AS (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM l GROUP BY 1, 2),
t AS (SELECT feature, count(*) AS n, avg(x) AS gm FROM l GROUP BY 1)
SELECT feature, any_value(t.n) AS n, round((sum(g.n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(g.n * v) / (any_value(t.n) - count(*))), 5) AS f_value
FROM g JOIN t USING (feature) GROUP BY feature""",
    ),
)
def anova_f(spark, sf):
    df = S.anova_f(fx_orders(spark, sf), _FEATURES, "label")
    return df.withColumn("f_value", F.round("f_value", 5))


_MI = ["amount", "balance"]


@query(
    "mutual_info_binned",
    over(
        "fx_orders",
        "WITH l AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, label AS y, {c} AS x FROM fx_orders WHERE {c} IS NOT NULL" for c in _MI)
        + """), q AS (SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM l GROUP BY feature),
b AS (SELECT feature, y, (x > e[1])::INT + (x > e[2])::INT + (x > e[3])::INT + (x > e[4])::INT + (x > e[5])::INT + (x > e[6])::INT
  + (x > e[7])::INT + (x > e[8])::INT + (x > e[9])::INT AS bin FROM l JOIN q USING (feature)),
c AS (SELECT feature, bin, y, count(*) AS n FROM b GROUP BY 1, 2, 3),
w AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, y) AS ny, sum(n) OVER (PARTITION BY feature) AS t FROM c)
SELECT feature, round(CAST(sum(n::DOUBLE / t * ln(n::DOUBLE * t / (nb::DOUBLE * ny))) AS DOUBLE), 10) AS mutual_info FROM w GROUP BY feature""",
    ),
)
def mutual_info_binned(spark, sf):
    df = S.mutual_information(fx_orders(spark, sf), _MI, "label")
    return df.withColumn("mutual_info", F.round("mutual_info", 10))


_MI_DOCS = {"n_chars": "n_chars", "rest": "n_chars % 97", "toxic": "toxic"}


@query(
    "mutual_info_neighbours",
    over(
        "fx_docs",
        "WITH l AS ("
        + " UNION ALL ".join(f"SELECT id, '{n}' AS feature, label AS y, CAST({e} AS DOUBLE) AS x FROM fx_docs WHERE {e} IS NOT NULL AND label IS NOT NULL" for n, e in _MI_DOCS.items())
        + """), c AS (SELECT feature, y, count(*) AS ny, least(3, count(*) - 1) AS k FROM l GROUP BY ALL HAVING count(*) > 1),
p AS (SELECT l.*, ny, k FROM l JOIN c USING (feature, y)),
r AS (SELECT a.feature, a.id, any_value(a.x) AS x, any_value(a.ny) AS ny, any_value(a.k) AS k, list_extract(list_sort(list(abs(a.x - b.x))), any_value(a.k)) AS r
  FROM p a JOIN p b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id GROUP BY a.feature, a.id),
m AS (SELECT r.feature, r.id, any_value(r.ny) AS ny, any_value(r.k) AS k, count(*) AS m FROM r JOIN p ON p.feature = r.feature AND (abs(p.x - r.x) < r.r OR p.x = r.x) GROUP BY r.feature, r.id),
h AS (SELECT i AS n, sum(CASE WHEN i > 1 THEN 1 / (i - 1)::DOUBLE ELSE 0 END) OVER (ORDER BY i) AS psi FROM range(1, 1 + (SELECT max(n) FROM (SELECT count(*) AS n FROM l GROUP BY feature))) t(i)),
t AS (SELECT feature, count(*) AS n FROM m GROUP BY feature)
SELECT m.feature, round(greatest(0.0, any_value(hn.psi) + avg(hk.psi) - avg(hy.psi) - avg(hm.psi)), 7) AS mutual_info
FROM m JOIN t USING (feature) JOIN h hn ON hn.n = t.n JOIN h hk ON hk.n = m.k JOIN h hy ON hy.n = m.ny JOIN h hm ON hm.n = m.m GROUP BY m.feature""",
    ),
)
def mutual_info_neighbours(spark, sf):
    """Mutual information by nearest neighbours, of values with and without ties."""
    df = fx_docs(spark, sf).withColumn("rest", F.col("n_chars") % 97)
    return neighbour_information(df, list(_MI_DOCS), "label").select("feature", F.round("mutual_info", 7).alias("mutual_info"))


@query(
    "join_left_default",
    over(
        "fx_items",
        """WITH s AS (SELECT family, CAST(sum(quantity) AS BIGINT) AS total FROM fx_items WHERE part = 'train' GROUP BY family)
SELECT id, coalesce(total, -1) AS total FROM fx_items LEFT JOIN s USING (family)""",
    ),
)
def join_left_default(spark, sf):
    df = fx_items(spark, sf)
    stats = df.filter(F.col("part") == "train").groupBy("family").agg(F.sum("quantity").alias("total"))
    return join_with_default(df, stats, ["family"], "total", -1).select("id", "total")


@query(
    "join_semi",
    over(
        "fx_items",
        """SELECT id, CASE WHEN family IN (SELECT family FROM fx_items WHERE label = 1 AND part = 'train') THEN 1 ELSE 0 END AS member
FROM fx_items""",
    ),
)
def join_semi(spark, sf):
    df = fx_items(spark, sf)
    members = df.filter((F.col("label") == 1) & (F.col("part") == "train")).select("family").distinct()
    return mark_members(df, members, ["family"], "member").select("id", "member")


@query(
    "join_semi_filter",
    over("fx_items", "SELECT id, family FROM fx_items WHERE family IN (SELECT family FROM fx_items WHERE quantity = 50)"),
)
def join_semi_filter(spark, sf):
    df = fx_items(spark, sf)
    return keep_members(df, df.filter(F.col("quantity") == 50), ["family"]).select("id", "family")


@query(
    "target_encode",
    over(
        "fx_items",
        """WITH r AS (SELECT family, CASE WHEN count(*) = 1 THEN 0.5::DOUBLE ELSE round_even(avg(label), 3) END AS rate
FROM fx_items WHERE part = 'train' GROUP BY family)
SELECT id, coalesce(rate, 0.5::DOUBLE) AS group_rate FROM fx_items LEFT JOIN r USING (family)""",
    ),
)
def target_encode(spark, sf):
    df = fx_items(spark, sf)
    encoder = T.GroupRate("family", "label").fit(df.filter(F.col("part") == "train"))
    return encoder.transform(df).select("id", "group_rate")


@query(
    "target_encode_docs",
    over(
        "fx_docs",
        """WITH r AS (SELECT family, CASE WHEN count(*) = 1 THEN 0.5::DOUBLE ELSE round_even(avg(label), 3) END AS rate FROM fx_docs GROUP BY family)
SELECT doc_id AS id, coalesce(rate, 0.5::DOUBLE) AS group_rate FROM documents LEFT JOIN r ON source = family""",
    ),
)
def target_encode_docs(spark, sf):
    """Fitted on labelled documents, applied to all documents."""
    encoder = T.GroupRate("family", "label").fit(fx_docs(spark, sf))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("family"))
    return encoder.transform(docs).select("id", "group_rate")


@query(
    "target_encode_loo",
    over(
        "fx_items",
        """WITH w AS (SELECT id, label, sum(label) OVER (PARTITION BY family) AS s, count(*) OVER (PARTITION BY family) AS n FROM fx_items)
SELECT id, CASE WHEN n = 1 THEN 0.5::DOUBLE ELSE (s - label)::DOUBLE / (n - 1) END AS group_rate FROM w""",
    ),
)
def target_encode_loo(spark, sf):
    return T.leave_one_out(fx_items(spark, sf), "family", "label").select("id", "group_rate")


@query(
    "target_encode_oof",
    over(
        "fx_orders",
        """WITH h AS (SELECT *, ('0x' || substr(md5(id || '|42'), 1, 8))::BIGINT AS h, (rel_a * 10 + rel_b) AS family FROM fx_orders),
f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY h, id) - 1) % 5 AS fold FROM h),
s AS (SELECT id, label, sum(label) OVER (PARTITION BY family) - sum(label) OVER (PARTITION BY family, fold) AS s,
 count(*) OVER (PARTITION BY family) - count(*) OVER (PARTITION BY family, fold) AS n FROM f)
SELECT id, CASE WHEN n = 0 THEN 0.5::DOUBLE ELSE s::DOUBLE / n END AS group_rate FROM s""",
    ),
)
def target_encode_oof(spark, sf):
    df = fx_orders(spark, sf).withColumn("family", F.col("rel_a") * 10 + F.col("rel_b"))
    folded = assign_folds(df, "id", "label", 5)
    return T.out_of_fold(folded, "family", "label", "fold").select("id", "group_rate")
