from collections import Counter

import pytest
from pyspark.sql import functions as F

from showloom.functions import html as H
from showloom.operators import captures
from showloom.sources import schemas as S
from showloom.sources.commits import read_published
from showloom.streaming.ingest import Ingest


def titles(pages):
    return captures.prepared(pages).select("page_id", "url", H.stripped_text(H.first(F.col("html"), H.css("title"))).alias("title"))


def land(spark, folder, *rows):
    made = [(i, u, f"<title>{t}</title>") for i, u, t in rows]
    spark.createDataFrame(made, S.PAGES).coalesce(1).write.mode("append").parquet(folder)


def result(ingest):
    return Counter((r.url, r.title) for r in ingest.result().collect())


CAPTURES = [
    [(1, "a", "a1"), (2, "b", "b1"), (3, "a", "a2")], [(4, "b", "b2"), (5, "c", "c1"), (6, None, "n1")],
    [(2, "b", "b1"), (7, "c", "c2"), (8, "d", "d1"), (9, None, "n2")], [(0, "a", "a0"), (3, "a", "a2"), (5, "c", "c1")],
]
NEWEST = Counter({("a", "a2"): 1, ("b", "b2"): 1, ("c", "c2"): 1, ("d", "d1"): 1, (None, "n2"): 1})


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0)])
@pytest.mark.parametrize("files", [1, 2, 3, None])
def test_the_result_does_not_depend_on_the_batches(spark, tmp_path, files, order):
    landing = str(tmp_path / "landing")
    ingest = Ingest(spark, str(tmp_path / "store"), titles)
    for i in order:
        land(spark, landing, *CAPTURES[i])
    for stream in ("s", "s", "other"):  # the second time nothing has arrived, the third time everything again
        ingest.run(landing, stream, files_per_batch=files)
        assert result(ingest) == NEWEST
    ingest.publish(str(tmp_path / "published"))
    land(spark, landing, (10, "e", "e1"), (11, "a", "a3"))
    ingest.run(landing, "s", files_per_batch=files)
    assert result(ingest) == NEWEST - Counter([("a", "a2")]) + Counter([("a", "a3"), ("e", "e1")])
    assert Counter((r.url, r.title) for r in read_published(spark, str(tmp_path / "published")).collect()) == NEWEST


def test_only_newer_pages_are_read(spark, tmp_path):
    ingest = Ingest(spark, str(tmp_path), titles)
    made = lambda rows: spark.createDataFrame([(i, u, f"<title>{t}</title>") for i, u, t in rows], S.PAGES)
    ingest.store_batch(made(CAPTURES[0]), "s", 0)
    ingest.store_batch(made(CAPTURES[3]), "s", 1)
    assert [(r.url, r.page_id) for r in spark.read.parquet(ingest.rows).filter("batch = 1").collect()] == [("c", 5)]


def test_a_batch_run_again_replaces_its_rows(spark, tmp_path):
    ingest = Ingest(spark, str(tmp_path), titles)
    batches = [
        spark.createDataFrame([(1, "a", "<title>a</title>"), (2, "b", "<title>b</title>")], S.PAGES),
        spark.createDataFrame([(3, "b", "<title>yes</title>"), (4, "c", "<title>c</title>")], S.PAGES),
    ]
    for batch_id in (0, 0, 1, 1):
        ingest.store_batch(batches[batch_id], "s", batch_id)
        ingest.store_batch(batches[batch_id], "s", batch_id)
    assert result(ingest) == Counter({("a", "a"): 1, ("b", "yes"): 1, ("c", "c"): 1})
    assert spark.read.parquet(ingest.rows).count() == 4


def test_pages_of_one_file_are_dealt_out(spark, tmp_path):
    spark.createDataFrame([(i, f"u{i}", "<title>t</title>") for i in range(50)], S.PAGES).coalesce(1).write.parquet(str(tmp_path / "landing"))
    seen = []

    def extract(pages):
        seen.append(pages.rdd.getNumPartitions())
        return pages.select("page_id", "url", "html")

    ingest = Ingest(spark, str(tmp_path / "kept"), extract)
    ingest.run(str(tmp_path / "landing"), "one", 1)
    assert seen == [spark.sparkContext.defaultParallelism] and ingest.result().count() == 50
