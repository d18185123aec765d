"""Queries over JSON, dict text, arrays and maps. Nested values are made and read inside a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested as N
from ..operators import site_c
from ..sources import schemas as S
from ..sources.tables import Tables
from . import rendered as R
from .registry import query

_LABELS = [
    "Orchestrations by", "Music by", "Lyrics by", "Book by", "Music and Lyrics by", "Music and Book by",
    "Book & Lyrics", "Music, Lyrics and Book by",
]


def _dict_text(poison: Column) -> Column:
    """``{'label': ["O'name", 'na\\xa0me'], 'Arranged by': ['brand']}``, label and names from the part."""
    label = F.get(F.array(*[F.lit(x) for x in _LABELS]), (F.col("p_size") % 8).cast("int"))
    first, last = (F.get(F.split("p_name", " "), F.lit(i)) for i in (0, 1))
    names = F.concat(F.lit("[\"O'"), first, F.lit("\", 'None "), last, F.lit("\\xa0\\'x\\''"), poison, F.lit("]"))
    other = F.concat(F.lit("'Arranged by': ['"), F.col("p_brand"), F.lit("']"))
    return F.concat(F.lit("{'"), label, F.lit("': "), names, F.lit(", "), other, F.lit("}"))


def _buckets(t: Tables, poison: Column) -> DataFrame:
    parsed = t.part.select("p_partkey", N.credit_buckets(N.literal_map(_dict_text(poison))).alias("b"))
    return parsed.select("p_partkey", *[N.bracketed(F.col(f"b.{n}")).alias(n) for n in (*N.CREDIT_ROLES, "others")])


def _buckets_sql(keep: str) -> str:
    pair = "'O''' || split_part(p_name, ' ', 1) || ', None ' || split_part(p_name, ' ', 2) || chr(160) || '''x'''"

    def bucket(sizes: str, name: str) -> str:
        return f"CASE WHEN {keep} AND p_size % 8 IN ({sizes}) THEN '[' || {pair} || ']' END AS {name}"

    others = f"CASE WHEN {keep} THEN '[' || CASE WHEN p_size % 8 = 0 THEN {pair} || ', ' ELSE '' END || p_brand || ']' END"
    return f"""
        SELECT p_partkey, {bucket('1, 4, 5, 7', 'music')}, {bucket('2, 4, 6, 7', 'lyrics')},
               {bucket('3, 5, 6, 7', 'book')}, {others} AS others
        FROM part
    """


@query(_buckets_sql("true"))
def credit_buckets(t: Tables) -> DataFrame:
    return _buckets(t, F.lit(""))


@query(_buckets_sql("p_partkey % 7 > 0"))
def credit_buckets_poison(t: Tables) -> DataFrame:
    """A ``None`` among the names of every seventh part."""
    return _buckets(t, F.when(F.col("p_partkey") % 7 == 0, ", None").otherwise(""))


@query(R.LINES_SQL + """
    SELECT doc_id,
           CAST(len(list_filter(lines, lambda l: length(l) % 4 = 0)) AS BIGINT) AS male,
           CAST(len(list_filter(lines, lambda l: length(l) % 4 = 1)) AS BIGINT) AS female,
           CAST(len(list_filter(lines, lambda l: length(l) % 4 = 2)) AS BIGINT) AS other
    FROM d
""")
def category_counts(t: Tables) -> DataFrame:
    """Genders in the characters made of the lines of a text."""
    cast = F.from_json(R.characters_json(), S.CHARACTERS)
    parsed = t.spread("documents").select("doc_id", cast.alias("c"))
    counts = N.gender_counts(F.col("c.Gender"))
    return parsed.select("doc_id", *[c.cast("bigint").alias(n) for n, c in counts.items()])


@query("""
    SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n
    FROM events GROUP BY event_type
""")
def json_field_parse(t: Tables) -> DataFrame:
    parsed = t.events.select("event_type", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))
    return parsed.groupBy("event_type").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("n"))


@query(R.LINES_SQL + """
    , c AS (
        SELECT doc_id, CASE WHEN doc_id % 11 = 0 OR doc_id % 17 = 0 THEN NULL
                            WHEN doc_id % 13 = 0 THEN lines[1:1] ELSE lines END AS kept FROM d
    )
    SELECT doc_id, CAST(len(kept) AS BIGINT) AS n,
           array_to_string(list_transform(kept, lambda l: split_part(l, ' ', 1)), '|') AS names,
           array_to_string(list_transform(kept, lambda l: l), '|') AS descriptions
    FROM c
""")
def json_array_parse(t: Tables) -> DataFrame:
    """Arrays of characters; some cut off, some empty text, some a single object."""
    whole = R.characters_json()
    single = N.to_json(F.get(R.characters(), F.lit(0)))
    text = (
        F.when(F.col("doc_id") % 11 == 0, F.expr("substr(w, 1, length(w) - 2)"))
        .when(F.col("doc_id") % 17 == 0, "")
        .when(F.col("doc_id") % 13 == 0, single)
        .otherwise(F.col("w"))
    )
    parsed = t.spread("documents").withColumn("w", whole).select("doc_id", F.from_json(text, S.CHARACTERS).alias("c"))
    return parsed.select(
        "doc_id",
        F.when(F.col("c").isNotNull(), F.size("c")).cast("bigint").alias("n"),
        F.array_join("c.Name", "|").alias("names"),
        F.array_join("c.Description", "|").alias("descriptions"),
    )


@query(R.LINES_SQL + """
    , p AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i, len(lines) AS total FROM d)
    SELECT doc_id * 1000000 + i AS sid, line AS show_title, CAST(total AS BIGINT) AS total,
           CAST(ceil(total / 150.0) AS BIGINT) AS n_pages
    FROM p
""")
def json_array_explode(t: Tables) -> DataFrame:
    """Listing payloads back to one row per product."""
    totals = site_c.listing_totals(t.spread("documents").select(R.listing_payload().alias("payload")))
    rows = totals.select("total", "n_pages", F.inline(F.from_json("payload", S.LISTING_PAYLOAD)["Products"]))
    return rows.select(F.col("Id").alias("sid"), F.col("Name").alias("show_title"), "total", "n_pages")


@query("""
    SELECT p_partkey,
           '[' || to_json({'Name': p_name, 'Age': CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS VARCHAR) END,
                           'Gender': NULL, 'Description': p_brand}) || ']' AS text,
           CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS VARCHAR) END AS age, p_brand AS description
    FROM part
""")
def json_round_trip(t: Tables) -> DataFrame:
    """Null fields stay in the text."""
    age = F.when(F.col("p_size") % 3 > 0, F.col("p_size").cast("string"))
    one = F.struct(
        F.col("p_name").alias("Name"), age.alias("Age"),
        F.lit(None).cast("string").alias("Gender"), F.col("p_brand").alias("Description"),
    )
    written = t.part.select("p_partkey", N.to_json(F.array(one)).alias("text"))
    back = written.withColumn("c", F.get(F.from_json("text", S.CHARACTERS), F.lit(0)))
    return back.select("p_partkey", "text", F.col("c.Age").alias("age"), F.col("c.Description").alias("description"))


@query("""
    SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(replace(text, chr(10), ' '), ' '))), '|') AS tags
    FROM documents
""")
def tags_distinct(t: Tables) -> DataFrame:
    """All words of a text as list text, read back, distinct and sorted."""
    words = F.replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(" "), F.lit("', '"))
    tags = N.literal_list(F.concat(F.lit("['"), words, F.lit("']")))
    return t.spread("documents").select("doc_id", F.array_join(N.distinct_tags(tags), "|").alias("tags"))


@query(R.LINES_SQL + """
    SELECT doc_id,
           array_to_string(list_transform(lines, lambda l, i: i || ':' || coalesce(split_part(l, ' ', 1) || ' ' ||
               CASE WHEN contains(l, ' ') THEN split_part(l, ' ', 2) END, '~')), '|') AS authors,
           array_to_string(list_transform(lines, lambda l, i: '/img/' || doc_id || '/' || i || '.png' ||
               CASE WHEN length(l) % 2 = 0 THEN ' (' || source || ')' ELSE '' END), '|') AS images
    FROM d
""")
def array_struct_transform(t: Tables) -> DataFrame:
    """Full names and projected fields per array element."""
    made = t.spread("documents").select("doc_id", R.authors().alias("a"), R.images().alias("i"))
    shaped = made.select("doc_id", F.transform("a", site_c.author).alias("a"), F.transform("i", site_c.image).alias("i"))
    credit = lambda i: F.when(i["image_credit"].isNotNull(), F.concat(F.lit(" ("), i["image_credit"], F.lit(")"))).otherwise("")
    return shaped.select(
        "doc_id",
        F.array_join(
            F.transform("a", lambda a: F.concat_ws(":", a["author_id"].cast("string"), F.coalesce(a["fullname"], F.lit("~")))), "|"
        ).alias("authors"),
        F.array_join(F.transform("i", lambda i: F.concat(i["image_url"], credit(i))), "|").alias("images"),
    )
