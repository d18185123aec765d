"""Queries over plain text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import nested as N
from ..functions import text as T
from ..operators import captures, diff
from ..operators.clean import cast_size
from ..operators.site_c import detail_url
from ..sources import schemas as S
from ..sources.tables import Tables
from .registry import query


@query("""
    SELECT p_partkey,
           CASE WHEN p_size % 7 = 0 OR p_size % 5 = 0 THEN NULL ELSE p_brand END AS cast_size_detail,
           CASE WHEN p_size % 7 = 0 THEN '' ELSE split_part(p_name, ' ', 1) END AS cast_size_category
    FROM part
""")
def paren_split(t: Tables) -> DataFrame:
    """Name and brand as ``name (brand)``, without parentheses or empty for some sizes."""
    text = (
        F.when(F.col("p_size") % 7 == 0, "")
        .when(F.col("p_size") % 5 == 0, F.col("p_name"))
        .otherwise(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    )
    sized = t.part.select("p_partkey", text.alias("cast_size"))
    return sized.select("p_partkey", *[c.alias(n) for n, c in cast_size(F.col("cast_size")).items()])


@query("""
    SELECT o_orderkey,
           CASE WHEN contains(o_orderpriority, '-') THEN split_part(o_orderpriority, '-', 2) END AS priority,
           split_part(CAST(o_orderkey AS VARCHAR), '9', 2) AS behind_nine,
           CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status
    FROM orders
""")
def after_delimiter(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    status = F.concat(F.lit("Status"), F.when(F.col("o_orderkey") % 3 > 0, ": ").otherwise(" "), "o_orderstatus", F.lit(": x"))
    return t.orders.select(
        "o_orderkey",
        T.after_delimiter(F.col("o_orderpriority"), "-").alias("priority"),
        F.coalesce(T.after_delimiter(key, "9"), F.lit("")).alias("behind_nine"),
        F.when(F.col("o_orderkey") % 3 > 0, T.after_delimiter(status)).alias("status"),
    )


@query("""
    SELECT p_partkey, p_type AS show_type,
           CASE WHEN p_size % 5 = 0 THEN '' ELSE split_part(p_name, ' ', 1) END AS genre
    FROM part
""")
def type_genre_split(t: Tables) -> DataFrame:
    """``type`` or ``type, genre, more``."""
    more = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.concat(F.lit(", "), F.replace("p_name", F.lit(" "), F.lit(", "))))
    listed = t.part.select("p_partkey", F.concat("p_type", more).alias("kind"))
    kind, genre = T.type_and_genre(F.col("kind"))
    return listed.select("p_partkey", kind.alias("show_type"), genre.alias("genre"))


@query("""
    SELECT p_partkey,
           CASE WHEN p_size % 6 > 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS VARCHAR) END AS fee
    FROM part
""")
def fee_after_colon(t: Tables) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    amount = F.concat(F.when(F.col("p_size") % 6 > 0, ":").otherwise(""), F.lit(" $"), price, F.lit(" "))
    return t.part.select("p_partkey", T.fee_amount(F.concat(F.lit("<strong>Fee</strong>"), amount)).alias("fee"))


@query("""
    SELECT doc_id,
           trim(regexp_replace(replace(trim(text, chr(10) || chr(9) || ' '), ',', ' '), '\\n+', ' ', 'g')) AS requirements,
           trim(replace(text, chr(10), '')) AS warning
    FROM documents
""")
def text_cleanup(t: Tables) -> DataFrame:
    """A heading in front, and NBSP runs for the commas."""
    text = F.col("text")
    wide = F.concat(F.lit("\n Requirements\n\n"), F.replace(text, F.lit(","), F.lit("\u00a0\u00a0")))
    return t.spread("documents").select(
        "doc_id",
        T.requirement_text(wide).alias("requirements"),
        T.warning_text(F.concat(F.lit(" Video Warning\r\n"), text, F.lit("\n"))).alias("warning"),
    )


@query("""
    SELECT d.doc_id, coalesce('quality ' || CAST(l.quality AS VARCHAR), 'unrated') AS rating,
           CASE WHEN l.toxic = 0 THEN d.lang ELSE 'None' END AS lang,
           CASE WHEN d.doc_id % 4 = 0 THEN 'none' ELSE d.source END AS source,
           CAST(CASE WHEN d.doc_id % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS has_source
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def default_fill(t: Tables) -> DataFrame:
    """Fallbacks for null (no label), ``""`` and ``"None"``."""
    known = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    rating = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    lang = F.when(F.col("toxic") == 0, F.col("lang")).otherwise("None")
    source = F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("source"))
    padded = F.concat(F.lit("\t "), source, F.lit(" "))
    return known.select(
        "doc_id",
        T.default_to(rating, "unrated").alias("rating"),
        T.default_to(lang, "None").alias("lang"),
        T.default_to(source, "none").alias("source"),
        T.has_text(padded).cast("bigint").alias("has_source"),
    )


@query("""
    SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]') THEN text ELSE '' END AS casting_info FROM documents
""")
def digit_predicate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.keep_if_digit(F.col("text")).alias("casting_info"))


@query("""
    SELECT page_id, rtrim(url, '/') || '/upcoming/' AS upcoming_url,
           'https://www.concordtheatricals.com/p/' || page_id || '/page-' || page_id AS product_url,
           'https://www.concordtheatricals.com/api/v1/products/' || page_id || '?' AS detail_url,
           'https://www.mtishows.com' || regexp_extract(html, '<a href="([^"]*)"', 1) AS first_link
    FROM pages
""")
def url_build(t: Tables) -> DataFrame:
    page = F.col("page_id").cast("string")
    link = H.first_attribute(F.col("html"), H.css("a"), "href")
    return captures.prepared(t.pages).select(
        "page_id",
        T.join_url(F.col("url"), "/upcoming/").alias("upcoming_url"),
        T.join_url(S.PRODUCT_URL_C, "/", page, F.lit("/page-"), page).alias("product_url"),
        detail_url(F.col("page_id")).alias("detail_url"),
        F.concat(F.lit(S.SITE_A), link).alias("first_link"),
    )


@query("""
    SELECT user_id, strftime(min(ts), '%Y-%m-%d') || ' to ' || strftime(max(ts), '%Y-%m-%d') AS production_date
    FROM events GROUP BY user_id
""")
def range_label(t: Tables) -> DataFrame:
    """First and last day per user. Minimum and maximum combine before the shuffle."""
    days = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    day = [F.date_format(c, "yyyy-MM-dd") for c in ("a", "b")]
    return days.select("user_id", T.date_range(*day).alias("production_date"))


@query("""
    SELECT p_partkey,
           CASE WHEN p_size % 7 = 0 THEN '' ELSE replace(p_name, ' ', ' & |') END AS awards,
           CAST(CASE WHEN p_size % 7 = 0 THEN 1 ELSE len(string_split(p_name, ' ')) END AS BIGINT) AS n
    FROM part
""")
def awards_list(t: Tables) -> DataFrame:
    """``<b>word &amp;</b>`` pieces in a comma list; some empty."""
    text = F.concat(F.lit("<p>"), F.replace("p_name", F.lit(" "), F.lit(" &amp;&nbsp;<!-- x -->, ")), F.lit("</p>"))
    award = F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(text)
    won = t.part.select("p_partkey", N.awards_map(H.visible_text(award))["awards"].alias("a"))
    return won.select(
        "p_partkey", F.array_join("a", "|").alias("awards"), F.size("a").cast("bigint").alias("n")
    )


_COUNTED = ["orders", "customer", "part", "lineitem", "supplier", "nation", "region", "events", "documents", "pages"]


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS listing, count(*) AS total, CAST(ceil(count(*) / 150.0) AS BIGINT) AS n_pages FROM {n}"
    for n in _COUNTED
))
def page_count(t: Tables) -> DataFrame:
    totals = [getattr(t, n).agg(F.count(F.lit(1)).alias("total")).select(F.lit(n).alias("listing"), "total") for n in _COUNTED]
    every = diff.union_rows(*totals)
    return every.withColumn("n_pages", T.page_count(F.col("total"), S.LISTING_SIZE_C))
