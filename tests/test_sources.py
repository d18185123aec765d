import pytest

from showloom.sources import schemas as S
from showloom.sources import tables
from showloom.sources.commits import Commits, publish, read_published


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a\nb, "c"', None), (2, "", "x"), (3, 'he said ""', "\\"), (4, "\r\n ,", " "), (None, "é", "null")]
    tables.write_csv(spark.createDataFrame(rows, "i int, t string, u string"), str(tmp_path / "t"))
    back = {tuple(r) for r in tables.read_csv(spark, str(tmp_path / "t"), "i int, t string, u string").collect()}
    assert back == set(rows)


NESTED = "i int, a array<string>, m map<string,array<int>>, s struct<x:int,y:string>, t string"


def test_nested_csv_round_trip(spark, tmp_path):
    rows = [
        (1, ["a, b", 'say "x"\n', None], {"k": [1, None]}, (None, "y"), "t"), (2, [], {}, (3, None), ""), (3, None, None, None, None),
        (None, ["\\", "é"], {"": []}, (1, "{}"), "[]"),
    ]
    tables.write_csv(spark.createDataFrame(rows, NESTED), str(tmp_path / "t"))
    back = tables.read_nested_csv(spark, str(tmp_path / "t"), NESTED).collect()
    got = {(r.i, repr(r.a), repr(r.m), r.s and tuple(r.s), r.t) for r in back}
    assert got == {(i, repr(a), repr(m), s, t) for i, a, m, s, t in rows} and all(r[tables.BAD] is None for r in back)


def test_bad_csv_rows_are_told(spark, tmp_path):
    lines = [
        "i,a,m,s,t", '1,"[""x""]",{},{},ok', "x,[],{},{},no number", "2,[],{},{}", "3,[],{},{},t,more", '4,"[""x",{},{},cut', "5,{},{},{},other type",
        '6,[],"{""k"":[""x""]}",{},other item', ",,,,",
    ]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    back = tables.read_nested_csv(spark, str(tmp_path / "t.csv"), NESTED).collect()
    assert [r.t for r in back if r[tables.BAD] is None] == ["ok", None]
    assert len(back) == 8 and back[2].i == 2


def test_counts_come_from_footers(spark, tmp_path):
    rows = [(1, "a", None), (None, None, None), (3, "c", None)]
    spark.createDataFrame(rows, "i int, `a b` string, n double").repartition(2).write.parquet(str(tmp_path / "t"))
    counted = tables.stored_counts(spark, str(tmp_path / "t"))
    assert tuple(counted.first()) == (2, 2, 0)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(i)" in plan and "ReadSchema: struct<count(i)" in plan


def test_nested_columns_go_to_csv_as_json(spark, tmp_path):
    one = spark.createDataFrame([(1, ["a"], {"k": ["b", None]}, (None, 2))], "i int, a array<string>, m map<string,array<string>>, s struct<x:int,y:int>")
    tables.write_csv(one, str(tmp_path / "t"))
    back = tables.read_csv(spark, str(tmp_path / "t"), "i int, a string, m string, s string").first()
    assert tuple(back) == (1, '["a"]', '{"k":["b",null]}', '{"x":null,"y":2}')


def test_snapshot_csv(spark, tmp_path):
    (tmp_path / "keys.csv").write_text("url,filter\nhttps://x/a/,broadway\nhttps://x/b/,young-part\n")
    got = tables.read_csv(spark, str(tmp_path / "keys.csv"), S.SNAPSHOT_B, multi_line=False)
    assert [tuple(r) for r in got.collect()] == [("https://x/a/", "broadway"), ("https://x/b/", "young-part")]


def test_append_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.range(2), path)
    tables.append(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4


def test_commits(spark, tmp_path):
    store = Commits(spark, str(tmp_path))
    assert store.read("t", "id bigint").count() == 0 and store.read_last("t", "id bigint").count() == 0 and store.records() == []
    for run_id, n in ((1, 2), (2, 5), (2, 3), (10, 4)):
        store.commit(run_id, {"t": store.stage("t", spark.range(n), run_id)})
    store.stage("t", spark.range(100), 11)  # not committed
    store.commit(3, {"other": store.stage("other", spark.range(7), 3)})
    assert store.read("t", "id bigint").columns == ["id", "run_id"]
    assert sorted((r.run_id, r["count"]) for r in store.read("t", "id bigint").groupBy("run_id").count().collect()) == [(1, 2), (2, 3), (10, 4)]
    assert store.read("t", "id bigint", before=10).count() == 5
    assert store.read_last("t", "id bigint", before=10).count() == 3 and store.read_last("t", "id bigint").count() == 4
    assert [(r.run_id, r.counts) for r in store.records(before=4)] == [(1, {"t": 2}), (2, {"t": 3}), (3, {"other": 7})]
    with pytest.raises(ValueError):
        store.commit(12, {"t": store.stage("t", spark.range(1), 12)}, {"t": 2})
    assert store.read("t", "id bigint").count() == 9


def test_publish_replaces_or_leaves(spark, tmp_path):
    path = str(tmp_path / "p")
    publish(spark.range(3), path, 3)
    old = read_published(spark, path)
    with pytest.raises(ValueError):
        publish(spark.range(2), path, 3)
    assert read_published(spark, path).count() == 3
    publish(spark.range(4), path)
    assert read_published(spark, path).count() == 4 and old.count() == 3  # a reader of the old one is not disturbed


def test_other_read_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception):
        tables.read_or_empty(spark, str(tmp_path), "not a schema(")


def test_work_folder_is_the_shared_one(spark):
    folder = tables.work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != tables.work_folder(spark, "x")


def test_small_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    t = tables.Tables(spark, str(tmp_path))
    assert t.spread("t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 50)
    assert tables.spread_scan(wide) is wide
