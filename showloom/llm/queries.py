"""The operators over the test tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard, leaks, licenses, neighbours, packing, quality, quotes, recompression, spelling, suffixes, tries, urls, warc
from .common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query()
def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    index = neighbours.ListIndex(vectors)
    return index.search(index.rows.filter(F.col("vec_id") % 100 == 0), 10)


def training_fold(doc_id):
    """Rows whose labels may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


@query()
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents")).drop("kept", "text_sha256")


@query("""
WITH words AS (
  SELECT n, doc_id, list_filter(string_split_regex(w, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws
  FROM (SELECT row_number() OVER () AS n, doc_id,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, list_slice(ws, p + 1, p + least(len(ws), 10)) AS win
  FROM (SELECT *, unnest(range(0, greatest(len(ws) - 9, 1))) AS p FROM items WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT n, size, p, list_slice(ws, p + 1, p + size) AS win
  FROM (SELECT n, ws, size, unnest(range(0, len(ws) - size + 1)) AS p FROM words, sizes WHERE len(ws) >= size)
),
hits AS (SELECT n, p, size, item_id FROM places JOIN windows USING (size, win)),
covered AS (SELECT n, count(DISTINCT p + i) AS n_hit FROM (SELECT n, p, unnest(range(0, size)) AS i FROM hits) GROUP BY n),
named AS (SELECT n, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT n, item_id FROM hits) GROUP BY n)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (n) LEFT JOIN named USING (n)
""")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = quality.train(docs, labels.filter(training_fold(F.col("doc_id"))))
    held_out = F.coalesce(~training_fold(F.col("doc_id")), F.lit(False))
    return quality.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


@query("""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
parts AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN url LIKE '%://%' THEN
           regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages
),
split AS (
  SELECT n, page_id,
         translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
  FROM parts
),
fits AS (
  SELECT n, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS place
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
""")
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query()
def op7_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """The table's messages, first written as mail that quotes what it answers."""
    return quotes.conversations(stored(quotes.quoting(table(spark, folder, "conversations")), "mail"))


@query()
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@query()
def op9_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.remove_passages(table(spark, folder, "documents")).drop("kept")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Closes each document.
END_ID = 1


@query()
def op10_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(), END_ID).drop("cost")


#: Checksum of a text in DuckDB, which has no function for it: a table made from the polynomial, then one step for each byte.
_CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
           lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS t
)"""


def _crc32_of(text: str) -> str:
    codes = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295)"


@query(f"""
WITH RECURSIVE {_CRC32},
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents)
  GROUP BY ALL
),
summed AS (SELECT run, n, {_crc32_of("id || ':' || run")} AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(n) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
shorter AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT DISTINCT s.word, w.word AS other FROM shorter s JOIN words w ON s.rest = w.word),
pairs AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, other FROM longer UNION ALL SELECT other, word FROM longer
),
ranked AS (
  SELECT p.word, w.word AS other, w.n, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, w.word) AS place,
         count(*) OVER (PARTITION BY p.word) AS n_near
  FROM pairs p JOIN words w ON p.other = w.word
),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.other END AS form,
         CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1
),
ends AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, e.root FROM forms f JOIN ends e ON f.form = e.word
)
SELECT word, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root FROM forms JOIN ends USING (word)
""")
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"))


@query(f"""
WITH {_CRC32},
marked AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
  FROM conversations WHERE conv_id IS NOT NULL
),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS pos FROM marked),
convs AS (
  SELECT c, {_crc32_of("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM marked), crc_table
),
parts AS (
  SELECT c, 0 AS part, pos, mark, size FROM convs JOIN turns ON conv_id = c - c % 5 AND pos <= h
  UNION ALL SELECT c, 1, pos, mark, size FROM convs JOIN turns ON conv_id = c AND pos > h
),
steps AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, mark, size FROM parts),
places AS (
  SELECT c, d, size, sha256(string_agg(mark, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM steps
  UNION ALL SELECT c, 0, 0, '' FROM convs
),
linked AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS above, max(d) OVER (PARTITION BY c) AS ends FROM places),
nodes AS (
  SELECT node, d, min(c) AS conv_id, min(above) AS above, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = ends), '')) AS ends_sha256
  FROM linked GROUP BY node, d
),
children AS (SELECT above AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT p.node, p.d, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum(n.saved) AS saved
  FROM nodes n JOIN linked p ON p.c = n.conv_id AND p.d <= n.d LEFT JOIN children k ON k.node = n.node AND k.d = n.d
  GROUP BY p.node, p.d
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.d = n.d
LEFT JOIN nodes a ON a.node = n.above AND a.d = n.d - 1
LEFT JOIN children k ON k.node = n.node AND k.d = n.d
""")
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.conversation_trie(table(spark, folder, "conversations"))


@query("""
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages
),
ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS kept
  FROM payloads WINDOW w AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST)
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND place > 1 THEN kept END AS refers_to
FROM ranked
""")
def op13_warc_records(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))
