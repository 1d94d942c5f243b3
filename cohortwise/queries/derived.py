"""Derived columns and bins."""

from pyspark.sql import functions as F

from cohortwise.functions import bins as B
from cohortwise.functions import numeric as N
from cohortwise.functions import text as X
from cohortwise.operators.metrics import histogram, kde_curve
from cohortwise.operators.quantiles import column_quantiles
from cohortwise.operators.target_encode import ratio_to_group_mean
from cohortwise.queries.fixtures import fx_docs, fx_items, fx_orders, fx_parts, over, table
from cohortwise.queries.registry import query


@query(
    "feat_size_alone",
    over("fx_orders", "SELECT id, rel_a + rel_b + 1 AS size, CASE WHEN rel_a + rel_b = 0 THEN 1 ELSE 0 END AS alone FROM fx_orders"),
)
def feat_size_alone(spark, sf):
    size = N.group_size(F.col("rel_a"), F.col("rel_b"))
    return fx_orders(spark, sf).select("id", size.alias("size"), N.is_alone(size).alias("alone"))


_TOKEN = r"regexp_extract(text, ' ([A-Za-z]+)\.', 1)"


@query(
    "feat_regex_token_map",
    f"""WITH t AS (SELECT doc_id, nullif({_TOKEN}, '') AS t FROM documents)
SELECT doc_id, CASE WHEN t IN ('the', 'and', 'of') THEN 'Rare' WHEN t IN ('que', 'de') THEN 'Miss' WHEN t IS NULL THEN 'Unknown' ELSE t END AS title FROM t""",
)
def feat_regex_token_map(spark, sf):
    mapping = {"the": "Rare", "and": "Rare", "of": "Rare", "que": "Miss", "de": "Miss"}
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", X.token_mapped(F.col("text"), X.TITLE_PATTERN, mapping).alias("title"))


@query(
    "feat_token_map_default",
    """WITH t AS (SELECT page_id, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS t FROM pages)
SELECT page_id, CASE WHEN t IS NULL THEN 'Unknown' WHEN t = 'en' THEN 'English' WHEN t IN ('fr', 'es') THEN 'Romance' ELSE 'Other' END AS lang FROM t""",
)
def feat_token_map_default(spark, sf):
    mapping = {"en": "English", "fr": "Romance", "es": "Romance"}
    pages = table(spark, sf, "pages")
    return pages.select("page_id", X.token_grouped(F.col("html"), '<html lang="([a-z]+)"', mapping).alias("lang"))


@query(
    "feat_token_map_fallback",
    f"""WITH t AS (SELECT doc_id, lang, {_TOKEN} AS t FROM documents),
m AS (SELECT doc_id, lang, CASE WHEN t = 'that' THEN 'the' WHEN t = 'le' THEN 'la' ELSE t END AS t FROM t)
SELECT doc_id, CASE WHEN t IN ('the', 'and', 'la', 'de') THEN t WHEN lang = 'en' THEN 'Mr' WHEN lang IN ('fr', 'de') THEN 'Mrs' END AS title FROM m""",
)
def feat_token_map_fallback(spark, sf):
    docs = table(spark, sf, "documents")
    title = X.token_or_fallback(
        F.col("text"), X.TITLE_PATTERN, {"that": "the", "le": "la"}, ["the", "and", "la", "de"], F.col("lang"),
        {"en": "Mr", "fr": "Mrs", "de": "Mrs"},
    )
    return docs.select("doc_id", title.alias("title"))


@query("feat_first_char", over("fx_parts", "SELECT id, coalesce(nullif(substr(brand, 1, 1), ''), 'Unknown') AS deck FROM fx_parts"))
def feat_first_char(spark, sf):
    return fx_parts(spark, sf).select("id", X.first_char(F.col("brand")).alias("deck"))


@query(
    "feat_first_int",
    "SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(url, '(\\d+)', 1), '') AS BIGINT), -1) AS number FROM pages",
)
def feat_first_int(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.first_int(F.col("url")).alias("number"))


@query(
    "feat_presence_count",
    over(
        "fx_parts",
        """SELECT p.id, CASE WHEN brand IS NULL THEN 0 ELSE 1 END AS has_brand,
CAST(length(name) - length(replace(name, ' ', '')) + 1 AS INT) AS name_tokens,
CASE WHEN brand IS NULL THEN 0 ELSE CAST(length(brand) - length(replace(brand, ' ', '')) + 1 AS INT) END AS brand_tokens FROM fx_parts p""",
    ),
)
def feat_presence_count(spark, sf):
    return fx_parts(spark, sf).select(
        "id",
        X.has_value(F.col("brand")).alias("has_brand"),
        X.token_count(F.col("name")).alias("name_tokens"),
        X.token_count(F.col("brand")).alias("brand_tokens"),
    )


@query(
    "feat_prefix",
    """SELECT o_orderkey AS id, coalesce(nullif(regexp_extract(o_orderpriority, '([A-Za-z/.]+)', 1), ''), 'None') AS prefix FROM orders""",
)
def feat_prefix(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), X.letter_prefix(F.col("o_orderpriority")).alias("prefix"))


@query(
    "feat_prefix_strip",
    r"""WITH t AS (SELECT page_id, trim(regexp_replace(url, '\d+', '', 'g')) AS b FROM pages)
SELECT page_id, CASE WHEN b IS NULL THEN 'Unknown' WHEN b = '' THEN 'Numeric' ELSE trim(replace(replace(b, '/', ''), '.', '')) END AS prefix FROM t""",
)
def feat_prefix_strip(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.prefix_without_digits(F.col("url")).alias("prefix"))


@query(
    "feat_trailing_int",
    over(
        "fx_parts",
        r"""WITH t AS (SELECT id, coalesce(TRY_CAST(nullif(regexp_extract(brand, '(\d+)$', 1), '') AS BIGINT), 0) AS number FROM fx_parts)
SELECT id, number, CASE WHEN number > 0 THEN 1 ELSE 0 END AS has_number FROM t""",
    ),
)
def feat_trailing_int(spark, sf):
    number = X.trailing_int(F.col("brand"))
    return fx_parts(spark, sf).select("id", number.alias("number"), N.flag(number > 0).alias("has_number"))


@query(
    "feat_last_int_len",
    r"""SELECT page_id, coalesce(TRY_CAST(regexp_extract_all(url, '\d+')[-1] AS BIGINT), -1) AS number, CAST(length(url) AS INT) AS url_length,
CAST(length(html) AS INT) AS html_length FROM pages""",
)
def feat_last_int_len(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", X.last_int(F.col("url")).alias("number"), F.length("url").alias("url_length"),
        F.length("html").alias("html_length"),
    )


@query("feat_group_key", "SELECT doc_id, nullif(regexp_extract(text, '([A-Za-z]+),', 1), '') AS surname FROM documents")
def feat_group_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.family_name(F.col("text")).alias("surname"))


@query(
    "feat_ratio",
    over("fx_orders", "SELECT id, coalesce(amount / (rel_a + rel_b + 1), amount) AS per_head, coalesce(amount / nullif(rel_a, 0), amount) AS per_a FROM fx_orders"),
)
def feat_ratio(spark, sf):
    size = N.group_size(F.col("rel_a"), F.col("rel_b"))
    return fx_orders(spark, sf).select(
        "id", N.ratio(F.col("amount"), size).alias("per_head"), N.ratio(F.col("amount"), F.col("rel_a")).alias("per_a")
    )


@query(
    "feat_products",
    over("fx_orders", "SELECT id, amount * klass AS amount_klass, amount * balance AS amount_balance, balance * klass AS balance_klass FROM fx_orders"),
)
def feat_products(spark, sf):
    a, b, k = F.col("amount"), F.col("balance"), F.col("klass")
    return fx_orders(spark, sf).select(
        "id", (a * k).alias("amount_klass"), (a * b).alias("amount_balance"), (b * k).alias("balance_klass")
    )


@query(
    "feat_transforms",
    """SELECT c_custkey, round(CASE WHEN c_acctbal > -1 THEN ln(1 + c_acctbal) END, 6) AS log_value, c_acctbal * c_acctbal AS squared,
round(CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END, 6) AS rooted FROM customer""",
)
def feat_transforms(spark, sf):
    v = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(N.log1p(v), 6).alias("log_value"), N.square(v).alias("squared"), F.round(N.root(v), 6).alias("rooted")
    )


@query(
    "feat_size_class",
    over(
        "fx_orders",
        """WITH s AS (SELECT id, rel_a + rel_b + 1 AS s FROM fx_orders)
SELECT id, CASE WHEN s = 1 THEN 'Alone' WHEN s IN (2, 3) THEN 'Small' WHEN s = 4 THEN 'Medium' WHEN s > 4 THEN 'Large' END AS size_class,
CASE WHEN s >= 5 THEN 'Large' ELSE 'Small' END AS legacy_class FROM s""",
    ),
)
def feat_size_class(spark, sf):
    size = N.group_size(F.col("rel_a"), F.col("rel_b"))
    return fx_orders(spark, sf).select(
        "id", N.size_class(size).alias("size_class"), N.size_class(size, legacy=True).alias("legacy_class")
    )


@query(
    "feat_flags",
    over(
        "fx_orders",
        """SELECT id, CAST(rel_a > 0 AS INT) AS has_a, CAST(rel_b > 0 AS INT) AS has_b, CAST(rel_a + rel_b + 1 > 4 AS INT) AS large_group,
CAST(rel_a + rel_b + 1 = 2 AS INT) AS pair FROM fx_orders""",
    ),
)
def feat_flags(spark, sf):
    a, b = F.col("rel_a"), F.col("rel_b")
    flags = N.family_flags(a, b, N.group_size(a, b))
    return fx_orders(spark, sf).select("id", *[c.alias(n) for n, c in flags.items()])


@query(
    "feat_ladder",
    """SELECT p_partkey AS id, CASE WHEN p_size < 5 THEN 'Baby' WHEN p_size < 12 THEN 'Child' WHEN p_size < 18 THEN 'Teen' WHEN p_size < 25 THEN 'YoungAdult'
WHEN p_size < 35 THEN 'Adult' WHEN p_size < 50 THEN 'MiddleAge' WHEN p_size < 65 THEN 'Senior' ELSE 'Elderly' END AS category FROM part""",
)
def feat_ladder(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), N.age_category(F.col("p_size")).alias("category"))


@query(
    "feat_tail_flags",
    over(
        "fx_orders",
        """WITH q AS (SELECT quantile_cont(amount, 0.2) AS lo, quantile_cont(amount, 0.8) AS hi FROM fx_orders)
SELECT id, CASE WHEN amount > hi THEN 1 ELSE 0 END AS expensive, CASE WHEN amount < lo THEN 1 ELSE 0 END AS cheap,
CASE WHEN balance < 1600 THEN 1 ELSE 0 END AS low_balance, CASE WHEN balance > 6000 THEN 1 ELSE 0 END AS high_balance FROM fx_orders, q""",
    ),
)
def feat_tail_flags(spark, sf):
    df = fx_orders(spark, sf)
    low, high = column_quantiles(df, "amount", [0.2, 0.8])
    return df.select(
        "id",
        N.flag(F.col("amount") > high).alias("expensive"),
        N.flag(F.col("amount") < low).alias("cheap"),
        N.flag(F.col("balance") < 1600).alias("low_balance"),
        N.flag(F.col("balance") > 6000).alias("high_balance"),
    )


@query(
    "feat_crosses",
    over(
        "fx_orders",
        "SELECT id, concat(segment, '_', klass) AS segment_klass, concat(coalesce(port, 'Unknown'), '_', klass) AS port_klass FROM fx_orders",
    ),
)
def feat_crosses(spark, sf):
    return fx_orders(spark, sf).select(
        "id",
        X.crossed(F.col("segment"), F.col("klass")).alias("segment_klass"),
        X.crossed(F.col("port"), F.col("klass")).alias("port_klass"),
    )


@query(
    "feat_group_ratio",
    over(
        "fx_items",
        """WITH m AS (SELECT family, sum(price_cents)::DOUBLE / count(*) AS m FROM fx_items GROUP BY family)
SELECT id, round(price_cents / m, 9) AS ratio FROM fx_items JOIN m USING (family)""",
    ),
)
def feat_group_ratio(spark, sf):
    df = ratio_to_group_mean(fx_items(spark, sf), "family", "price_cents", "ratio")
    return df.select("id", F.round("ratio", 9).alias("ratio"))


@query(
    "bin_left_closed",
    over(
        "fx_orders",
        """SELECT id, CASE WHEN balance >= 0 AND balance < 1000 THEN 'b0' WHEN balance >= 1000 AND balance < 2500 THEN 'b1'
WHEN balance >= 2500 AND balance < 5000 THEN 'b2' WHEN balance >= 5000 AND balance < 9000 THEN 'b3' END AS bin FROM fx_orders""",
    ),
)
def bin_left_closed(spark, sf):
    edges = [0, 1000, 2500, 5000, 9000]
    bins = B.cut(F.col("balance"), edges, ["b0", "b1", "b2", "b3"], right=False)
    return fx_orders(spark, sf).select("id", bins.alias("bin"))


@query(
    "bin_right_closed",
    """SELECT p_partkey AS id, CASE WHEN p_size > 0 AND p_size <= 12 THEN 0 WHEN p_size > 12 AND p_size <= 20 THEN 1
WHEN p_size > 20 AND p_size <= 40 THEN 2 WHEN p_size > 40 AND p_size <= 60 THEN 3 WHEN p_size > 60 THEN 4 END AS bin FROM part""",
)
def bin_right_closed(spark, sf):
    bins = B.cut(F.col("p_size"), [0, 12, 20, 40, 60, float("inf")], [0, 1, 2, 3, 4])
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), bins.alias("bin"))


_QUARTILES = """WITH q AS (SELECT min(amount) AS q0, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS q2,
quantile_cont(amount, 0.75) AS q3, max(amount) AS q4 FROM fx_orders)
SELECT id, CASE WHEN amount <= q1 THEN {} WHEN amount <= q2 THEN {} WHEN amount <= q3 THEN {} WHEN amount <= q4 THEN {} END AS bin FROM fx_orders, q"""


@query("bin_quartiles", over("fx_orders", _QUARTILES.format("'Low'", "'Mid'", "'High'", "'Top'")))
def bin_quartiles(spark, sf):
    df = fx_orders(spark, sf)
    edges, labels = B.quantile_edges(df, "amount", [0.0, 0.25, 0.5, 0.75, 1.0], ["Low", "Mid", "High", "Top"])
    return df.select("id", B.cut(F.col("amount"), edges, labels, include_lowest=True).alias("bin"))


@query("bin_qcut", over("fx_orders", _QUARTILES.format(0, 1, 2, 3)))
def bin_qcut(spark, sf):
    df = fx_orders(spark, sf)
    edges, labels = B.quantile_edges(df, "amount", [0.0, 0.25, 0.5, 0.75, 1.0], [0, 1, 2, 3])
    return df.select("id", B.cut(F.col("amount"), edges, labels, include_lowest=True).alias("bin"))


@query(
    "bin_equal_width",
    over(
        "fx_orders",
        """WITH r AS (SELECT min(amount) AS lo, (max(amount) - min(amount)) / 5 AS w FROM fx_orders)
SELECT id, CASE WHEN amount <= lo + w THEN 'Low' WHEN amount <= lo + 2 * w THEN 'Med-Low' WHEN amount <= lo + 3 * w THEN 'Med'
WHEN amount <= lo + 4 * w THEN 'Med-High' WHEN amount IS NOT NULL THEN 'High' ELSE 'Unknown' END AS bin FROM fx_orders, r""",
    ),
)
def bin_equal_width(spark, sf):
    df = fx_orders(spark, sf)
    bins = B.equal_width(df, "amount", ["Low", "Med-Low", "Med", "Med-High", "High"])
    return df.select("id", F.coalesce(bins, F.lit("Unknown")).alias("bin"))


@query(
    "hist_density",
    over(
        "fx_orders",
        """WITH r AS (SELECT min(amount) AS lo, max(amount) AS hi, (max(amount) - min(amount)) / 30 AS w, count(amount) AS total FROM fx_orders),
e AS (SELECT CAST(i AS INT) AS bin, lo + i * w AS a, CASE WHEN i = 29 THEN hi ELSE lo + (i + 1) * w END AS b, w, total FROM r, range(30) t(i)),
c AS (SELECT bin, count(*) AS n FROM e JOIN fx_orders ON amount >= a AND (amount < b OR (bin = 29 AND amount <= b)) GROUP BY bin)
SELECT e.bin, round(a, 4) AS left_edge, coalesce(n, 0) AS n, round(coalesce(n, 0)::DOUBLE / total / w, 12) AS density FROM e LEFT JOIN c ON e.bin = c.bin""",
    ),
)
def hist_density(spark, sf):
    df = histogram(fx_orders(spark, sf), "amount", 30)
    return df.withColumns({"left_edge": F.round("left_edge", 4), "density": F.round("density", 12)})


@query(
    "kde_curve",
    over(
        "fx_docs",
        """WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, (max(n_chars) - min(n_chars))::DOUBLE AS spread, count(*) AS n,
stddev_samp(n_chars) * pow(count(*), -0.2) AS h FROM fx_docs),
b AS (SELECT least(floor((n_chars - lo) / (spread / 512)), 511) AS bin, count(*) AS c FROM fx_docs, s GROUP BY 1),
g AS (SELECT CAST(i AS INT) AS i, lo - spread / 2 + i * (2 * spread / 199) AS x FROM s, range(200) t(i))
SELECT i, round(x, 4) AS x, round(sum(c * exp(-0.5 * pow((x - (lo + (bin + 0.5) * (spread / 512))) / h, 2))) / (n * h * sqrt(2 * pi())), 12) AS density
FROM g, b, s GROUP BY i, x, n, h""",
    ),
)
def kde_curve_query(spark, sf):
    df = kde_curve(fx_docs(spark, sf), "n_chars", 200, 512)
    return df.withColumns({"x": F.round("x", 4), "density": F.round("density", 12)})


@query(
    "feat_short_map",
    over("fx_items", "SELECT id, CASE WHEN title = 'Mr' THEN 'Miss' WHEN title = 'Master' THEN 'Mrs' ELSE title END AS title FROM fx_items"),
)
def feat_short_map(spark, sf):
    title = X.replace_values(F.col("title"), {"Mr": "Miss", "Master": "Mrs"})
    return fx_items(spark, sf).select("id", title.alias("title"))
