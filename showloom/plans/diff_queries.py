"""Queries comparing and combining tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..operators import captures, diff
from ..operators.site_c import listing_with_details
from ..sources.tables import Tables
from .registry import query

_SPLIT = "2024-01-16"
_KEYED = f"""
    WITH keyed AS (
        SELECT event_id, ts, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    ),
    o AS (SELECT user_id, k FROM keyed WHERE ts < TIMESTAMP '{_SPLIT}'),
    n AS (SELECT event_id, user_id, k FROM keyed WHERE ts >= TIMESTAMP '{_SPLIT}')
"""
_NULLED = _KEYED.replace(
    "CAST(json_extract(props, '$.k') AS BIGINT)",
    "CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 10 > 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END",
)


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Events keyed by user and ``k``, before and from the middle of the month."""
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    split = F.lit(_SPLIT).cast("timestamp")
    old = t.events.filter(F.col("ts") < split).select("user_id", k)
    new = t.events.filter(F.col("ts") >= split).select("event_id", "user_id", k)
    return old, new


def _with_null_keys(df: DataFrame) -> DataFrame:
    """Every tenth value of ``k`` becomes null, on both sides."""
    return df.withColumn("k", F.when(F.col("k") % 10 > 0, F.col("k")))


@query(_KEYED + """
    SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.user_id = n.user_id AND o.k = n.k)
""")
def new_keys_anti(t: Tables) -> DataFrame:
    old, new = _halves(t)
    return diff.new_rows(old, new, ["user_id", "k"])


@query(_NULLED + """
    SELECT * FROM n WHERE NOT EXISTS (
        SELECT 1 FROM o WHERE o.user_id = n.user_id AND o.k IS NOT DISTINCT FROM n.k)
""")
def new_keys_null_safe(t: Tables) -> DataFrame:
    """Keys with nulls on both sides; a null key matches a null key."""
    old, new = (_with_null_keys(df) for df in _halves(t))
    return diff.new_rows(old, new, ["user_id", "k"])


@query(_KEYED + "SELECT event_id, user_id, k FROM keyed")
def first_run_all_new(t: Tables) -> DataFrame:
    """No earlier snapshot: everything is new."""
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    new = t.events.select("event_id", "user_id", k)
    return diff.new_rows(diff.empty_like(t.spark, "user_id bigint, k bigint"), new, ["user_id", "k"])


_STATUS = _NULLED + """,
    oc AS (SELECT user_id, k, count(*) AS c FROM o GROUP BY ALL),
    nc AS (SELECT user_id, k, count(*) AS c FROM n GROUP BY ALL),
    m AS (
        SELECT coalesce(oc.user_id, nc.user_id) AS user_id, coalesce(oc.k, nc.k) AS k,
               CASE WHEN oc.c IS NULL THEN 'added' WHEN nc.c IS NULL THEN 'removed' ELSE 'both' END AS status,
               coalesce(oc.c, 1) * coalesce(nc.c, 1) AS copies
        FROM oc FULL OUTER JOIN nc ON oc.user_id = nc.user_id AND oc.k IS NOT DISTINCT FROM nc.k
    )
"""


@query(_STATUS + """
    SELECT user_id, k, status FROM (
        SELECT user_id, k, status, unnest(range(copies)) FROM m WHERE status <> 'both')
""")
def snapshot_symmetric_diff(t: Tables) -> DataFrame:
    old, new = (_with_null_keys(df) for df in _halves(t))
    return diff.symmetric_diff(old, new, ["user_id", "k"])


@query(_STATUS + "SELECT status, CAST(sum(copies) AS BIGINT) AS n FROM m GROUP BY status")
def snapshot_status_counts(t: Tables) -> DataFrame:
    old, new = (_with_null_keys(df) for df in _halves(t))
    return diff.status_counts(old, new, ["user_id", "k"])


@query("""
    SELECT o_orderkey, o_custkey AS sid, c_custkey AS show_id, c_name, o_orderpriority
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def listing_detail_inner(t: Tables) -> DataFrame:
    listing = t.orders.select("o_orderkey", F.col("o_custkey").alias("sid"), "o_orderpriority")
    detail = t.customer.select(F.col("c_custkey").alias("show_id"), "c_name")
    return listing_with_details(listing, detail)


@query("""
    SELECT count(d.doc_id) AS doc_id, count(lang) AS lang, count(source) AS source, count(quality) AS quality,
           count(toxic) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def column_nonnull_profile(t: Tables) -> DataFrame:
    known = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return diff.nonnull_counts(known)


@query(_KEYED + """,
    fresh AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.user_id = n.user_id AND o.k = n.k))
    SELECT 'all' AS diff, count(*) AS n, count(*) = 0 AS is_empty FROM fresh
    UNION ALL SELECT 'again', 0, true
""")
def empty_gate(t: Tables) -> DataFrame:
    """The gate on a diff with news, and on one of a table against itself."""
    old, new = _halves(t)
    news = diff.row_count_gate(diff.new_rows(old, new, ["user_id", "k"]))
    none = diff.row_count_gate(diff.new_rows(new, new, ["user_id", "k"]))
    return captures.tagged(news, "all", "diff").unionByName(captures.tagged(none, "again", "diff"))


@query("""
    SELECT doc_id, source, lang FROM documents WHERE lang = 'en'
    UNION ALL SELECT doc_id, source, lang FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'label ' || quality, NULL FROM labels
""")
def append_union(t: Tables) -> DataFrame:
    """Rows of several tables one behind the other, matched by column name."""
    docs = t.documents.select("doc_id", "source", "lang")
    other = t.labels.select(
        F.lit(None).cast("string").alias("lang"), "doc_id", F.concat(F.lit("label "), F.col("quality").cast("string")).alias("source")
    )
    return diff.union_rows(docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en"), other)


@query("""
    SELECT regexp_extract(html, '<html lang="([^"]*)"', 1) AS filter,
           unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS url
    FROM pages
""")
def tagged_listing_union(t: Tables) -> DataFrame:
    """Links of every page under the page's language as the tag, all languages in one pass."""
    lang = H.first_attribute(F.col("html"), H.css("html"), "lang")
    links = H.every(F.col("html"), H.css("li"), lambda e: H.first_attribute(e, H.css("a"), "href"))
    return captures.prepared(t.pages).select(lang.alias("filter"), F.explode(links).alias("url"))
