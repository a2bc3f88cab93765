"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sedimenta.llm.token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.decontam import contained_items

    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.knn import top_inner_products

    return top_inner_products(_table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.suffix_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.near_dedup import near_components

    return near_components(_table(spark, sf_dir, "documents"), percent=85)


def url_list(hosts: DataFrame) -> DataFrame:
    """A dated list over the hosts of a table, by a fixed rule on the hash of each name, and two fixed entries.

    (list, entry, action, since): hosts are added, most are removed again, some are added anew; of other
    hosts only a path is listed.
    """
    bucket = F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int")
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("b") % 400)
    hosts = hosts.select("host").where("host IS NOT NULL").distinct().withColumn("b", bucket)
    listed, paths = hosts.where("b % 3 = 0"), hosts.where("b % 3 = 1")
    ended = F.date_add(start, 30 + F.col("b") % 7 * 20)
    rows = [
        listed.select("host", F.lit("add").alias("action"), start.alias("since")),
        listed.where("b % 5 <> 0").select("host", F.lit("remove").alias("action"), ended.alias("since")),
        listed.where("b % 4 = 0").select("host", F.lit("add").alias("action"), F.date_add(start, 300).alias("since")),
        paths.select(F.concat("host", F.lit("/en")).alias("host"), F.lit("add").alias("action"), start.alias("since")),
    ]
    fixed = hosts.sparkSession.sql(
        "SELECT * FROM VALUES ('example.org', 'add', DATE'2024-02-01'), ('example.org', 'remove', DATE'2024-05-01'), ('adult-x.example.net', 'add', DATE'2020-01-01') AS t(host, action, since)"
    )
    out = fixed
    for part in rows:
        out = out.unionByName(part)
    return out.select(F.lit("blocked").alias("list"), F.col("host").alias("entry"), "action", "since")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.url_filters import host_of, judge

    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 730).cast("int")))
    return judge(captures, url_list(pages.select(host_of(F.col("url")).alias("host"))))


OP2_SQL = r"""
WITH captures AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 730 AS INT) AS DATE) AS fetched_at,
    nullif(lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$', ''), '\.+$', '')), '') AS host,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)', 1), '^/+|/+$', '', 'g') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 4) AS INT) AS b FROM captures WHERE host IS NOT NULL),
entries AS (
  SELECT host AS key, 'add' AS action, CAST(DATE '2024-01-01' + b % 400 AS DATE) AS since FROM hosts WHERE b % 3 = 0
  UNION ALL SELECT host, 'remove', CAST(DATE '2024-01-01' + b % 400 + 30 + b % 7 * 20 AS DATE) FROM hosts WHERE b % 3 = 0 AND b % 5 <> 0
  UNION ALL SELECT host, 'add', CAST(DATE '2024-01-01' + b % 400 + 300 AS DATE) FROM hosts WHERE b % 3 = 0 AND b % 4 = 0
  UNION ALL SELECT host || '/en', 'add', CAST(DATE '2024-01-01' + b % 400 AS DATE) FROM hosts WHERE b % 3 = 1
  UNION ALL SELECT 'example.org', 'add', DATE '2024-02-01' UNION ALL SELECT 'example.org', 'remove', DATE '2024-05-01'
  UNION ALL SELECT 'adult-x.example.net', 'add', DATE '2020-01-01'),
log AS (SELECT key, since, max(action) AS action FROM entries GROUP BY key, since),
steps AS (SELECT *, lag(action) OVER (PARTITION BY key ORDER BY since) AS before FROM log),
changes AS (SELECT * FROM steps WHERE action IS DISTINCT FROM before),
spans AS (
  SELECT key, since AS valid_from, valid_to FROM (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS valid_to FROM changes) WHERE action = 'add'),
keys AS (
  SELECT DISTINCT url, fetched_at, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
    CASE WHEN path = '' THEN [] ELSE list_transform(range(1, len(string_split(path, '/')) + 1), lambda i: host || '/' || array_to_string(string_split(path, '/')[:i], '/')) END)) AS key
  FROM captures WHERE host IS NOT NULL),
active AS (
  SELECT k.url, k.fetched_at, s.key, s.valid_from FROM keys k JOIN spans s ON k.key = s.key
  WHERE s.valid_from <= k.fetched_at AND (s.valid_to IS NULL OR k.fetched_at < s.valid_to)),
best AS (
  SELECT url, fetched_at, key, valid_from, count(*) OVER w AS n, row_number() OVER (w ORDER BY length(key) DESC, key, valid_from) AS place
  FROM active WINDOW w AS (PARTITION BY url, fetched_at))
SELECT c.page_id, c.url, c.fetched_at, b.n IS NOT NULL AS blocked, CAST(coalesce(b.n, 0) AS BIGINT) AS n_entries, b.key AS blocked_by, b.valid_from AS blocked_since
FROM captures c LEFT JOIN best b ON c.url = b.url AND c.fetched_at = b.fetched_at AND b.place = 1
"""


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.pii import replace_entities

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key="sedimenta", count_to="n_entities")


def op4_sampled_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sedimenta.llm.sp_sampling import sample_encodings

    return sample_encodings(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), k=3, digest=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.html_extract import extract_main_text

    return extract_main_text(_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.prefix_trie import branched_turns, conversation_trie, ordered_turns
    from sedimenta.llm.store import Scratch

    scratch = Scratch(spark, "prefix_trie")
    own = scratch.save(ordered_turns(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", scratch))
    turns, conversations = branched_turns(own)
    return conversation_trie(scratch.save(turns), conversations, scratch)


OP11_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
known AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON c.base = b.conv_id),
rebuilt AS (
  SELECT k.conv_id, t.place AS d, t.role, t.text FROM known k JOIN turns t ON t.conv_id = k.base AND t.place <= k.taken
  UNION ALL SELECT k.conv_id, k.taken + t.place - k.h, t.role, t.text FROM known k JOIN turns t ON t.conv_id = k.conv_id AND t.place > k.h),
steps AS (
  SELECT conv_id, d, strlen(text) AS n_bytes, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY d) AS key FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
ends AS (SELECT conv_id, max(d) AS d FROM steps GROUP BY conv_id),
nodes AS (
  SELECT s.key, s.d AS depth, min(s.conv_id) AS conv_id, count(*) AS n_convs, any_value(s.n_bytes) AS n_bytes,
    sha256(coalesce(string_agg(s.conv_id::VARCHAR, ',' ORDER BY s.conv_id) FILTER (WHERE e.d = s.d), '')) AS ends_sha256
  FROM steps s JOIN ends e ON s.conv_id = e.conv_id GROUP BY s.key, s.d),
kids AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.key = k.key),
sums AS (
  SELECT key[1:up] AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * n_bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON n.key = s.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1]
"""


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sedimenta.llm.spelling import common_words, group_variants, runs, with_slips
    from sedimenta.llm.store import Scratch

    scratch = Scratch(spark, "spelling")
    words = scratch.save(common_words(with_slips(runs(_table(spark, sf_dir, "documents")))))
    return group_variants(words, scratch)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filters": op2_url_filters,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_sampled_encodings": op4_sampled_encodings,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_knn_join": op7_knn_join,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_near_dedup": op10_near_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}
SQL: dict[str, str] = {"op2_url_filters": OP2_SQL, "op11_prefix_trie": OP11_SQL}
