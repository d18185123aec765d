"""Extraction of whole records, and the daily jobs."""

import json

import pytest
from pyspark.sql import functions as F

from showloom.operators import captures, site_a, site_b, site_c
from showloom.plans.collect import Store, clean_job, collect_a, collect_b, collect_c
from showloom.sources import schemas as S
from showloom.sources.commits import Commits, read_published

A = "https://www.mtishows.com"


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], S.PAGES)


def show(n, extra=""):
    return f"<html><a class='mti-print-button' href='/print/{n}'>p</a>{extra}</html>"


def printed(n, extra=""):
    return f"<html><div class='field-name-field-show-title-full'> Show {n} </div>{extra}</html>"


def test_record_a_without_any_field(spark):
    shows = spark.createDataFrame([("u1",), ("u2",), (None,)], "show_url string")
    got = site_a.records(shows, pages(spark, ("u1", "<html></html>"))).collect()
    assert [r.asDict() for r in got] == [{c: ("u1" if c == "show_url" else None) for c in site_a.COLUMNS}]


def test_schema_of_raw_catalogues(spark):
    shows = spark.createDataFrame([("u1",)], "show_url string")
    expected = spark.createDataFrame([], S.RAW_A).schema
    got = site_a.records(shows, pages(spark, ("u1", "x"))).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in expected]
    expected = spark.createDataFrame([], S.RAW_B).schema
    got = site_b.records(shows.selectExpr("show_url AS url", "'x' AS filter"), pages(spark, ("u1", "x"))).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in expected]


def test_record_a_takes_the_latest_capture(spark):
    captured = pages(
        spark, ("u1", show(9)), (A + "/print/1", printed("old")), ("u1", show(1)), (A + "/print/1", printed("new")),
        (A + "/print/9", printed("nine")),
    )
    shows = spark.createDataFrame([("u1",), ("u1",)], "show_url string")
    assert [r.show_title for r in site_a.records(shows, captured).collect()] == ["Show new"] * 2


@pytest.mark.parametrize("rows, expected", [
    ("<div>N</div><div class='character__row'><p class='character__age'>Age:  9 </p><p class='character__description'> d</p></div>",
     [("N", " 9 ", None, " d")]),
    ("<div>N</div><div class='character__row'><p class='character__age'>nine</p><p class='character__description'>d</p></div>", None),
    ("<div>N</div><div class='character__row'></div>", None),
    ("<div class='character__row'><p class='character__description'>d</p></div>", None),
    ("", None),
])
def test_characters(paged, rows, expected):
    got = paged(site_a.characters, f"<div class='box'>{rows}</div>")
    assert (got and [tuple(r) for r in got]) == expected


def test_awards_and_billing(paged):
    html = (
        "<div class='show_awards_container'><div class='show-awards__group'><h4 class='awards_type_group'> T </h4>"
        "<li class='awards__item'> a </li></div><div class='show-awards__group'><h4 class='awards_type_group'>T</h4></div></div>"
    )
    assert paged(site_a.awards, html) == {"T": []}
    assert paged(site_a.awards, "<div class='show_awards_container'></div>") is None
    assert paged(site_a.awards, "<div class='show_awards_container'><p class='show-awards__group'></p></div>") is None
    html = (
        "<div class='field-attribution-label'>Music by</div><div class='item-list'><a>A</a><a> B </a></div>"
        "<div class='field-attribution-label'>Book by</div><div class='field-attribution-label'>Lyrics by</div>"
        "<div class='item-list x'><a>C</a></div>"
    )
    assert paged(site_a.billing, html) == {"Music by": ["A", "B"], "Book by": ["C"], "Lyrics by": ["C"]}
    assert paged(site_a.billing, "<div>none</div>") is None


def test_orchestration(paged):
    table = "<table class='table-styled'><tr><td>a</td><td>1</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"
    got = paged(site_a.orchestration, f"<h1>x</h1>{table}<h3> STANDARD ORCHESTRATION</h3><h3>ALTERNATE ORCHESTRATION</h3>{table}")
    assert got.asDict(True) == {
        "Materials": [{"Resource": "a", "Quantity": "1"}],
        "Orchestration": {"ALTERNATE ORCHESTRATION": [{"Instrumentation": "a", "Doubling": "b", "Quantity": "c"}]},
    }
    assert paged(site_a.orchestration, f"<h1>x</h1>{table}").asDict(True)["Orchestration"] == {}
    assert paged(site_a.orchestration, f"<h1>x</h1>{table}<h3>STANDARD ORCHESTRATION</h3>") is None
    assert paged(site_a.orchestration, f"{table}<h1>x</h1>") is None
    wrapped = paged(site_a.orchestration, f"<h1>x</h1>{table}<h3><b>STANDARD ORCHESTRATION</b></h3>{table}")
    assert list(wrapped["Orchestration"]) == ["STANDARD ORCHESTRATION"]


def test_available_resource_needs_all_parts(paged):
    item = (
        "<div class='resource-results-view-content'><div class='resource-view-title'><a href='/r'> R </a></div>"
        "<div class='resource-view-description'>d</div><div class='resource-view-type-wrapper'>t</div>{}</div>"
    )
    image = "<div class='resource-view-image'><img src='/i'></div>"
    box = "<div class='resource-results-view'>{}</div>"
    assert [tuple(r) for r in paged(site_a.available_resource, box.format(item.format(image)))] == [("R", "/r", "d", "t", "/i")]
    assert paged(site_a.available_resource, box.format(item.format(image) + item.format(""))) is None
    assert paged(site_a.available_resource, box.format("")) == []
    assert paged(site_a.available_resource, "<div></div>") is None


def test_record_b_missing_values_are_null(spark):
    html = (
        "<div id='show-overview'><ul class='list-unstyled'><li class='author-info'> </li></ul><h3>Related Shows</h3><a href='1'>x</a></div>"
        "<div id='show-casting-information'><p>no number</p></div><div id='show-synopsis'></div>"
        "<div class='pull-right extra-links'><a class='btn btn-success btn-lg' href='1'>x</a></div><div id='show-credits'></div>"
    )
    shows = spark.createDataFrame([("u/", "broadway"), ("u/", "young-part")], "url string, filter string")
    upcoming = "<div class='upcoming'><h5>L</h5><span class='date-display-start'>a</span><span class='date-display-end'>b </span></div>"
    got = site_b.records(shows, pages(spark, ("u/", html), ("u/upcoming/", upcoming))).orderBy("show_type").collect()
    assert [r.show_type for r in got] == ["broadway", "young-part"]
    given = {"show_type", "show_url", "cast_list", "upcoming_productions"}
    assert {c for c, v in got[0].asDict().items() if v is not None} == given
    assert got[0].cast_list == ["no number"] and [tuple(p) for p in got[0].upcoming_productions] == [("a to b", "L")]


def listing_a(*urls):
    items = "".join("<div class='alphabetical-item'>" + (f"<a href='{u}'>x</a>" if u else "x") + "</div>" for u in urls)
    return f"<div class='region region-content'><div class='alphabetical-container'>{items}</div></div>"


def stored(store, schema="show_title string"):
    return store.read("rows", schema)


def test_collect_a(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    captured = pages(spark, *[(f"u{n}", show(n)) for n in (1, 2, 3)], *[(f"{A}/print/{n}", printed(n)) for n in (1, 2, 3)])
    first = pages(spark, ("l", listing_a("u1", "u2", None)))
    assert collect_a(store, first, captured, 1)
    assert sorted(r.show_title for r in stored(store).collect()) == ["Show 1", "Show 2"]
    assert not collect_a(store, first, captured, 2)
    assert collect_a(store, pages(spark, ("l", listing_a("u2", "u3", None))), captured, 3)
    # u3 is new; u1 is gone and read again
    third = stored(store).filter("run_id = 3")
    assert sorted(r.show_title for r in third.collect()) == ["Show 1", "Show 3"]
    changes = {(r.show_url, r.status) for r in store.read("changes", S.LOG_A).filter("run_id = 3").collect()}
    assert changes == {("u3", "added"), ("u1", "removed")}
    # u1 stays gone, and nothing is written for it again
    assert not collect_a(store, pages(spark, ("l", listing_a("u2", "u3", None))), captured, 4)
    assert [r.run_id for r in store.commits.records()] == [1, 3]
    # it is new when it is listed again, and a null key goes like any other
    assert collect_a(store, pages(spark, ("l", listing_a("u1", "u2", "u3"))), captured, 5)
    events = {(r.show_url, r.status) for r in store.read("log", S.LOG_A).filter("run_id = 5").collect()}
    assert events == {("u1", "listed"), (None, "gone")}


TITLES = "show_title string, show_type string"


def listing_b(*urls):
    box = "<div class='col-md-4 col-sm-6 col-xs-12 views-col'><a href='{}'>x</a><div class='list-title'><h3>t</h3></div></div>"
    return "".join(box.format(u) for u in urls)


def test_collect_b(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    captured = pages(spark, *[(f"u{n}/", f"<h1 class='single-title custom-post-type-title'>{n}</h1>") for n in (1, 2, 3)])
    one = pages(spark, ("http://x/show-type/broadway/?l=en", listing_b("u1/", "u2/")), ("http://x/show-type/young-part/", listing_b("u2/")))
    assert collect_b(store, one, captured, 1)
    got = sorted((r.show_title, r.show_type) for r in stored(store, TITLES).collect())
    assert got == [("1", "broadway"), ("2", "broadway"), ("2", "young-part")]
    assert not collect_b(store, one, captured, 2)
    two = pages(spark, ("http://x/show-type/broadway/", listing_b("u3/", "u1/")))
    assert collect_b(store, two, captured, 3)
    # the same run again, as after a failure, changes nothing
    assert collect_b(store, two, captured, 3)
    assert sorted(r.show_title for r in stored(store).collect()) == ["1", "2", "2", "3"]
    # u2 left the listing in run 3, so it is new when it comes back
    assert collect_b(store, one, captured, 4)
    assert sorted((r.show_title, r.show_type) for r in stored(store, TITLES).filter("run_id = 4").collect()) == [
        ("2", "broadway"), ("2", "young-part"),
    ]


def product(n, kind="Play, Comedy"):
    return {
        "Id": n, "Name": f"P{n}", "SeName": f"p-{n}", "TitleCasting": "2m", "TitleTypeOfPlayAndGenre": kind,
        "Authors": [{"Id": 1, "FirstName": "A", "LastName": "B"}], "Tags": ["x"], "ShortDescription": "<p>s</p>",
        "ProductImages": [{"Id": 1, "Type": "t", "Height": 3, "ImageUrl": "/i", "PhotoCredit": None}],
    }


def detail(n):
    return {
        "Id": n, "ShortDescription": "<p>a&amp;b</p>", "FullDescription": None, "LicensingFeeDisplay": "<strong>Fee</strong>: $5",
        "TitleAttributeDisplayModel": {"DescriptionDuration": "90", "DescriptionAwards": "<b>A</b>", "PerformanceGroups": [{"Name": "G"}]},
    }


def payloads(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_collect_c(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    details = payloads(spark, *[detail(n) for n in (1, 2, 3)])
    one = payloads(spark, {"ProductTotal": 151, "Products": [product(1), product(2, "Musical")]})
    assert tuple(site_c.listing_totals(one).select("total", "n_pages").first()) == (151, 2)
    details = details.withColumn("n", F.lit(1))
    assert collect_c(store, one, details, 1, "n")
    first = spark.read.parquet(f"{tmp_path}/data/rows").orderBy("sid").first()
    assert (first.sid, first.show_id, first.show_type, first.genre, first.minimum_license_fee) == (1, 1, "Play", "Comedy", "$5")
    assert first.show_url == "https://www.concordtheatricals.com/p/1/p-1" and first.brief_synopsis == "a&b"
    assert first.summary == "" and first.awards == {"awards": ["A"]} and first.performance_groups == ["G"]
    assert first.authors[0].fullname == "A B" and first.image_urls[0].image_height == 3
    assert not collect_c(store, one, details, 2, "n")
    assert collect_c(store, payloads(spark, {"Products": [product(2), product(3), product(4)]}), details, 3, "n")
    assert sorted(r.sid for r in stored(store, "sid bigint").collect()) == [1, 2, 3]
    profile = store.read("profile", "sid bigint, genre bigint, short_description bigint").filter("run_id = 3").first()
    assert (profile.sid, profile.genre, profile.short_description) == (2, 2, 2)


def test_clean_job(spark, tmp_path):
    shows = spark.createDataFrame([("u1",)], "show_url string")
    raw = site_a.records(shows, pages(spark, ("u1", show(1)), (A + "/print/1", printed(1, "<p class='cast-info__name-size'>Cast: Big (9)</p>"))))
    raw.write.parquet(str(tmp_path / "raw"))
    clean_job(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    clean_job(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    got = read_published(spark, str(tmp_path / "clean")).collect()
    assert len(got) == 1
    got = got[0]
    assert (got.cast_size_category, got.cast_size_detail, got.male_character_count, got.music_by) == ("Big", "9", 0, None)
    with pytest.raises(Exception):
        clean_job(spark, str(tmp_path / "missing"), str(tmp_path / "clean"))


def test_listings(spark):
    assert [r.show_url for r in captures.listing_a(pages(spark, ("l", listing_a("a", None, "b")))).collect()] == ["a", None, "b"]
    tagged = captures.tagged(spark.range(1), "t")
    assert tagged.first().filter == "t"
    assert captures.listing_b(pages(spark, ("x", listing_b("a", "a"))), F.lit("c")).count() == 2


def test_the_newest_capture_counts_also_without_fields(spark):
    shows = spark.createDataFrame([("u1",)], "show_url string")
    captured = pages(spark, ("u1", show(1)), (A + "/print/1", printed("old")), (A + "/print/1", "<html></html>"))
    every_kind = site_a.records(shows, captured, captured, captured).collect()
    assert site_a.records(shows, captured).collect() == every_kind and every_kind[0].show_title is None

    listed = spark.createDataFrame([("u/", "x")], "url string, filter string")
    upcoming = "<div class='upcoming'><h5>L</h5><span class='date-display-start'>a</span><span class='date-display-end'>b</span></div>"
    captured = pages(spark, ("u/", "<html></html>"), ("u/upcoming/", upcoming), ("u/upcoming/", "<html></html>"))
    assert site_b.records(listed, captured).first().upcoming_productions is None


def test_a_detail_captured_again_does_not_double_its_product(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    again = {**detail(1), "LicensingFeeDisplay": "<strong>Fee</strong>: $9"}
    details = spark.createDataFrame([(2, json.dumps(again)), (1, json.dumps(detail(1))), (3, None), (4, "{}")], "n int, payload string")
    assert collect_c(store, payloads(spark, {"Products": [product(1)]}), details, 1, order="n")
    assert [r.minimum_license_fee for r in stored(store, "minimum_license_fee string").collect()] == ["$9"]
    bad = store.read("quarantine", "payload string, reason string").collect()
    assert [(r.payload, r.reason) for r in bad] == [(None, "missing")]


def test_a_run_that_fails_before_its_record_has_done_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    captured = pages(spark, *[(f"u{n}/", f"<h1 class='single-title custom-post-type-title'>{n}</h1>") for n in (1, 2, 3)])
    listing = pages(spark, ("http://x/show-type/broadway/", listing_b("u1/", "u2/")))
    stage = Commits.stage
    for broken in ("keys", "changes", "rows"):
        def failing(self, name, df, run_id, broken=broken):
            place = stage(self, name, df, run_id)  # written, but the run ends here
            if name == broken:
                raise RuntimeError(name)
            return place

        monkeypatch.setattr(Commits, "stage", failing)
        with pytest.raises(RuntimeError):
            collect_b(store, listing, captured, 1)
        assert store.commits.records() == [] and stored(store).count() == 0
    monkeypatch.setattr(Commits, "stage", stage)
    assert collect_b(store, listing, captured, 1)
    assert sorted(r.show_title for r in stored(store).collect()) == ["1", "2"]


def test_quarantine(spark):
    good = json.dumps(detail(1))
    rows = [good, good[:-1], "", None, '{"Id": "x"}', '{"Id": 1, "Other": []}', "[1]", "nothing", '{"TitleAttributeDisplayModel": 3}']
    df = spark.createDataFrame([(p,) for p in rows], "payload string")
    got = {r.payload: r.reason for r in site_c.quarantined(df, S.DETAIL_PAYLOAD).collect()}
    assert got == {good[:-1]: "syntax", "": "empty", None: "missing", '{"Id": "x"}': "type", "[1]": got["[1]"], "nothing": "syntax",
                   '{"TitleAttributeDisplayModel": 3}': "type"}


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_key_filter_loses_nothing_and_keeps_little(spark, n):
    pages = spark.range(20_000).select(F.col("id").cast("string").alias("url"), "id")
    pages = pages.unionByName(spark.createDataFrame([(None, -1)], "url string, id bigint"))
    keys = spark.range(n).select((F.col("id") * 5).cast("string").alias("url")).unionByName(spark.createDataFrame([(None,)], "url string"))
    got = captures.wanted(pages, keys, ["url"])
    assert got.columns == ["url", "id"]
    ids = {r.id for r in got.collect()}
    assert ids >= {-1, *range(0, 5 * n, 5)} and len(ids) < n + 60
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_the_last_detail_moves_its_payload_once(spark):
    from showloom.operators import site_c

    def payload(n, text):
        return f'{{"Id": {n}, "LicensingFeeDisplay": "<strong>Fee</strong>: {text}"}}'

    rows = [(1, payload(7, "a")), (None, payload(7, "z")), (3, payload(7, "c")), (3, payload(7, "d")), (2, payload(8, "e")), (4, None), (5, "{")]
    last = site_c.latest_details(spark.createDataFrame(rows, "n long, payload string"), "n")
    assert {r.show_id: r.minimum_license_fee for r in last.collect()} == {7: "d", 8: "e"}
    # a payload next to an order that holds it again would be shuffled twice
    assert "max_by" not in last._jdf.queryExecution().toString()


def test_the_newest_of_repeated_and_odd_captures(spark):
    html = "<div id='show-credits'>{}</div>"
    rows = [
        (1, "a", "old"), (3, "a", "new"), (2, "a", "mid"), (4, "b", "one"), (5, "c", "twin"), (5, "c", "twin"), (None, "d", "x"),
        (7, None, "y"), (None, "e", "x"), (6, "e", "e"),
    ]
    captured = spark.createDataFrame([(i, u, html.format(t)) for i, u, t in rows], S.PAGES)
    fields = {"credits": site_b.show_fields(F.col("html"))["show_credits"]}
    got = captures.newest(captured, fields, "key", captures.repeated(captured))
    assert got.columns == ["key", "credits"]
    # as grouping all of them gives it: a capture without a number tells nothing
    assert {r.key: r.credits for r in got.collect()} == {"a": "new", "b": "one", "c": "twin", "d": None, "e": "e"}
    every_one = captures.key_filter(captured, ["url"])
    assert sorted(captures.newest(captured, fields, "key", every_one).collect()) == sorted(got.collect())


def test_fields_of_pages_captured_once_are_not_grouped(spark, monkeypatch):
    html = "<div id='show-credits'>{}</div>"
    shows = spark.createDataFrame([(f"u{i}/", "x") for i in range(5)], "url string, filter string")
    once = [(f"u{i}/", html.format(i)) for i in range(5)]
    grouped, latest = [], captures.latest

    def counted(records, key):
        grouped.append(records.count())
        return latest(records, key)

    monkeypatch.setattr(captures, "latest", counted)
    for captured, n in ((once, 0), ([("u1/", html.format("old")), *once], 2)):
        found = site_b.records(shows, pages(spark, *captured)).collect()
        assert {r.show_url: r.show_credits for r in found} == {f"u{i}/": str(i) for i in range(5)}
        assert grouped[-2:] == [n, n]


def test_links_of_a_show_find_their_pages(spark):
    table = "<h1>T</h1><table class='table-styled'><tr><td>r</td><td>{}</td></tr></table><h3>STANDARD ORCHESTRATION</h3><table class='table-styled'></table>"
    link = "<a class='mti-show-materials' href='/m/{}'></a>"
    captured = pages(
        spark, ("u1", show(1, link.format(1))), ("u2", show(2)), ("u3", link.format(1)), ("u4", show(1, link.format(9))),
        (A + "/print/1", printed("one")), (A + "/m/1", table.format(1)),
    )
    shows = spark.createDataFrame([(f"u{i}",) for i in (1, 1, 2, 3, 4, 5)], "show_url string")
    got = site_a.records(shows, captured).collect()
    shown = [(r.show_url, r.show_title, r.orchestration_resources and r.orchestration_resources.Materials[0].Quantity) for r in got]
    assert sorted(shown, key=str) == [
        ("u1", "Show one", "1"), ("u1", "Show one", "1"), ("u2", None, None), ("u3", None, "1"), ("u4", "Show one", None),
    ]


def test_a_staged_table_is_small_and_leaves_no_shuffle(spark, tmp_path):
    import time

    import pyarrow.parquet as pq

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    commits, before = Commits(spark, str(tmp_path)), shuffled()
    rows = spark.range(0, 1000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(4, "id")
    place = commits.stage("rows", rows, 1)
    until = time.time() + 20
    while not shuffled() <= before and time.time() < until:
        time.sleep(0.2)
    assert shuffled() <= before and commits.staged("rows", place).count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    files = list((tmp_path / "data" / "rows").rglob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}


def test_a_detail_with_one_payload_is_not_grouped(spark, monkeypatch):
    rows = [(1, '{"Id": 1}'), (None, '{"Id": 2}'), (2, '{"Id": 3}'), (1, '{"Id": 3, "LicensingFeeDisplay": "a: b"}'), (5, None), (6, "{")]
    given = spark.createDataFrame(rows, "n int, payload string")
    grouped, may_hold = [], site_c.may_hold

    def counted(found, bits, on):
        found = may_hold(found, bits, on)
        grouped.append(found.count())
        return found

    monkeypatch.setattr(site_c, "may_hold", counted)
    got = site_c.latest_details(given, "n").select("show_id", "minimum_license_fee").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, None), (3, None)] and grouped == [2]
