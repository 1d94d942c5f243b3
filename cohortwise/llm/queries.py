"""One query per operator of this subpackage, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm import chat, credentials, decontaminate, exact, langid, licenses, pack, quality, resample, simhash, subwords, substrings, trie
from cohortwise.session import small_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


# CRC-32 in SQL: a table of 256 numbers made by its rule, then one look-up for each byte of a string's UTF-8 form.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, b: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END)))"""


def _crc(text: str, table: str) -> str:
    code = f"""list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS UBIGINT))"""
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {code}), lambda c, b: xor(c >> 8, list_extract({table}, CAST(xor(c & 255, b) + 1 AS BIGINT)))), CAST(4294967295 AS UBIGINT))"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    packed = pack.pack_documents(_table(spark, sf_dir, "documents"))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query("op2_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op3_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in every document."""
    found = credentials.scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", F.col("joined").alias("spans"))


@_query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from a network trained on the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select(F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score")


@_query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select(F.col("id").alias("doc_id"), quality.held_out("id").alias("held_out"), "score", predicted.alias("predicted"))


@_query("op6_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, with its loss mask."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = chat.END + chat.START + "assistant ok"
    both = small_table(spark, [(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema.simpleString()[7:-1].replace(",", ", "))
    done = chat.format_records(chat.records_of(rows.unionByName(both)))
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.under_mask(F.col("formatted"), F.col("loss_mask"))
    return done.select(
        F.col("id").alias("conv_id"),
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


@_query("op7_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.LicenseClassifier.train(docs))


@_query(
    "op8_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
         g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM d JOIN g USING (text)
    """,
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept row and size of the group of equal texts of every document."""
    marked = exact.mark_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep="largest")
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query("op9_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents."""
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op10_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document because they repeat earlier documents."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


@_query("op11_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the distinct-word table, and the text decoded from them, as digests."""
    found = subwords.encode(_table(spark, sf_dir, "documents"))
    listed = F.to_json("pieces")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("pieces").cast("long").alias("n_tokens"),
        F.sha2(F.substring(listed, F.lit(2), F.length(listed) - 2).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


_TRIE = f"""
    WITH k AS (SELECT {_CRC_TABLE} AS crc),
      t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
      l AS (SELECT conv_id, max(pos) AS own FROM t GROUP BY conv_id),
      c AS (SELECT l.*, conv_id - conv_id % 5 AS base, CAST({_crc("CAST(conv_id AS VARCHAR)", "crc")} % 9 AS BIGINT) AS head FROM l, k),
      h AS (SELECT c.*, least(head, coalesce(b.own, 0)) AS shared FROM c LEFT JOIN l b ON b.conv_id = c.base),
      r AS (SELECT h.conv_id, pos, role, text FROM h JOIN t ON t.conv_id = h.base WHERE pos <= shared
        UNION ALL SELECT h.conv_id, pos - head + shared, role, text FROM h JOIN t USING (conv_id) WHERE pos > head),
      m AS (SELECT conv_id, octet_length(encode(text)) AS size, string_agg(md5(role || chr(10) || length(role) || chr(10) || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM r
        UNION ALL SELECT conv_id, 0, '' FROM h),
      n AS (SELECT prefix, min(conv_id) AS conv_id, length(prefix) // 32 AS depth, count(*) AS n_convs, max(size) AS size FROM m GROUP BY prefix),
      kids AS (SELECT left(prefix, length(prefix) - 32) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
      o AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * size AS saved FROM n LEFT JOIN kids USING (prefix)),
      u AS (SELECT left(prefix, 32 * d) AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM o) GROUP BY 1),
      e AS (SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max(prefix) AS prefix FROM m GROUP BY conv_id) GROUP BY prefix)
    SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM o JOIN u ON u.prefix = o.prefix LEFT JOIN n p ON o.depth > 0 AND p.prefix = left(o.prefix, length(o.prefix) - 32) LEFT JOIN e ON e.prefix = o.prefix
"""


@_query("op12_prefix_trie", _TRIE)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with sums over its subtree."""
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


@_query("op13_importance_resampling")
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the longer documents, drawn towards the benchmark texts, with every document's weight."""
    found = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
