"""Native expressions against row-at-a-time Python, on the same rows.

Prints one JSON line: seconds for the credits and gender columns as Python UDFs and as native
expressions, and megabytes of HTML per second and core for the print pages: all 15 fields and
the four plain text fields with native expressions, and those four out of a tree built with the
standard library's tokenizer in one Python process.
"""

from __future__ import annotations

import ast
import json
import os
import time

from pyspark.sql import functions as F

from bench import session
from showloom.functions import nested as N
from showloom.operators import captures, site_a
from showloom.plans import rendered as R
from showloom.plans.catalog_queries import raw_catalog
from showloom.sources import schemas as S
from showloom.sources.tables import Tables, work_folder
from tests.test_html import Tree


def timed(df) -> float:
    best = float("inf")
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def python_buckets(text):
    try:
        credits = ast.literal_eval(text or "None") or {}
    except (ValueError, SyntaxError):
        credits = {}
    if any(n is None for names in credits.values() for n in names):
        credits = {}
    found = {role: [n for k, v in credits.items() if role in k.lower() for n in v] for role in N.CREDIT_ROLES}
    found["others"] = [n for k, v in credits.items() if not any(r in k.lower() for r in N.CREDIT_ROLES) for n in v]
    return {k: v or None for k, v in found.items()}


def python_genders(genders):
    lowered = [g.lower() for g in genders or [] if g is not None]
    male, female = lowered.count("male"), lowered.count("female")
    return [male, female, len(lowered) - male - female]


def python_fields(html):
    """The plain text fields only, looked up in a tree."""
    classes = {}
    for node in Tree(html).root.walk():
        for token in (node.attrs.get("class") or "").split():
            classes.setdefault(token, node)
    return [classes[c].text.strip() if c in classes else None for c in site_a.PRINT_TEXT.values()]


def main() -> None:
    spark = session()
    t = Tables(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    folder = work_folder(spark, "compare")
    raw_catalog(t).select("billing", F.from_json("characters", S.CHARACTERS)["Gender"].alias("g")).write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    for _ in range(6):
        raw = raw.union(raw)
    buckets = F.udf(python_buckets, "struct<music:array<string>,lyrics:array<string>,book:array<string>,others:array<string>>")
    genders = F.udf(python_genders, "array<int>")

    pages = R.pages_of(t.spread("documents"), F.lit("u"), R.print_page_a())
    pages.write.parquet(f"{folder}/pages")
    pages = spark.read.parquet(f"{folder}/pages")
    megabytes = pages.agg(F.sum(F.octet_length("html"))).first()[0] / 1e6
    cores = spark.sparkContext.defaultParallelism
    fields = site_a.print_fields(F.col("html"))
    prepared = captures.prepared(pages)
    native = timed(prepared.select(*[c.alias(n) for n, c in fields.items()]))
    native_text = timed(prepared.select(*[fields[n].alias(n) for n in site_a.PRINT_TEXT]))
    python = 0.0
    for row in pages.select("html").toLocalIterator():  # the same pages as the native side reads
        start = time.perf_counter()
        python_fields(row.html)
        python += time.perf_counter() - start

    print(json.dumps({
        "rows": raw.count(),
        "credits_udf": timed(raw.select(buckets("billing"))),
        "credits_native": timed(raw.select(N.credit_buckets(N.literal_map(F.col("billing"))))),
        "genders_udf": timed(raw.select(genders("g"))),
        "genders_native": timed(raw.select(*N.gender_counts(F.col("g")).values())),
        "html_mb": round(megabytes, 1),
        "html_native_all_fields_mb_per_core_second": round(megabytes / native / cores, 2),
        "html_native_text_fields_mb_per_core_second": round(megabytes / native_text / cores, 2),
        "html_python_text_fields_mb_per_core_second": round(megabytes / python, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
