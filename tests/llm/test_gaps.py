"""Null and repeated ids, ties, empty tables, long texts and bounds that are reached."""

import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import found, frame

from showloom.llm import common, leaks, neighbours, packing, recompression, repeats, suffixes, urls


def repeated(seed=4):
    """Rows that share ids, null ids, repeated rows and empty texts, with passages in common."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ok", "é", "Ist")]
    passage = " ".join(rng.choice(words) for _ in range(80))
    rows = []
    for i in range(30):
        own = " ".join(rng.choice(words) for _ in range(rng.choice([3, 60, 300])))
        doc = rng.choice([None, 3, 3, 5, i, i + 100])
        rows.append((doc, rng.choice([own, f"{own} {passage} {own}", passage, f"{passage} {passage}", None, ""])))
    return rows + rows[:4]


@pytest.mark.parametrize("piece", [None, 300])
def test_repeats_with_null_and_repeated_ids(spark, monkeypatch, piece):
    if piece:  # texts far longer than what is looked at together
        monkeypatch.setattr(repeats, "PIECE", piece)
        monkeypatch.setattr(repeats, "BATCH_BYTES", 2000)
    rows = repeated()
    got = found(suffixes.remove_repeats(frame(spark, rows).repartition(3)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.byte_repeats(rows), key=repr)
    got = found(recompression.remove_passages(frame(spark, rows).repartition(3)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.word_repeats(rows), key=repr)


def test_contamination_of_null_and_repeated_ids(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(None, f"x {item} y"), (2, item), (2, "clean words"), (2, item), (None, None), (3, ""), (4, item.replace("five", "5"))]
    bench = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "")], "item_id long, text string")
    got = found(leaks.contamination(frame(spark, rows), bench), "doc_id", "n_words", "n_hit", "contaminated")
    assert got == sorted([(None, 13, 11, True), (2, 11, 11, True), (2, 2, 0, False), (2, 11, 11, True), (None, 0, 0, False), (3, 0, 0, False), (4, 11, 0, False)], key=repr)
    kept = leaks.clean(frame(spark, rows), bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(2, "clean words"), (None, None), (3, ""), (4, rows[-1][1])], key=repr)


@pytest.mark.parametrize("within", [4, 10])
def test_proximity(spark, within):
    rng = random.Random(within)
    rare = ["alpha", "beta", "gamma"]
    rows = []
    for i in range(60):
        words = [rng.choice(["the", "of", "and", "a"]) for _ in range(rng.choice([5, 40, 90]))]
        for w in rng.sample(rare, rng.choice([2, 3])) * rng.choice([1, 2]):
            words.insert(rng.randrange(len(words) + 1), w)
        rows.append((i, " ".join(words)))
    bench = spark.createDataFrame([(1, "the alpha of beta and gamma"), (2, "the delta never said")], "item_id long, text string")
    index = leaks.PhraseIndex(frame(spark, rows), bench)
    got = {(r.doc_id, r.place) for r in leaks.near_matches(index, within).collect()}
    wanted = set()
    for i, text in rows:
        words = text.split(" ")
        for p, w in enumerate(words):
            if w in rare and set(rare) <= set(words[p : p + within]):
                wanted.add((i, p))
                break
    assert got == wanted and wanted


def test_packing_of_many_blocks_and_odd_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(packing, "SLICE_BYTES", 500)
    path = __import__("public_tokenizers").path("byte_bpe_50k.json")
    rows = [(None, "a b c"), (None, "a b c"), (1, None), (1, ""), (2, "word " * 5000), (3, "é"), (3, "x y"), *((i, "some words here " * (i % 40)) for i in range(10, 90))]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    pieces = packing.pack(frame(spark, rows).coalesce(2), path, 1).collect()
    counts = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(p.length for p in pieces) == sum(counts) and sorted(p.doc_tokens for p in pieces if p.start == 0) == counts
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 2048
    one = [p for p in pieces if p.doc_id == 2]
    ids = np.array(plain.encode("word " * 5000, add_special_tokens=False).ids + [1], "<u4")
    assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in one)


def test_neighbours_ties_copies_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    index = neighbours.ListIndex(spark.createDataFrame([], schema))
    assert index.search(index.rows, 10).collect() == []
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(7, [1.0, 2.0]), (100, [1.0, 3.0]), (200, None), (300, [0.0, 0.0]), (400, [math.nan, 1.0]), (500, [1.0, None]), (None, [1.0, 2.0])]
    index = neighbours.ListIndex(spark.createDataFrame(rows, schema))
    got = {}
    for r in index.search(index.rows.filter(F.col("vec_id") % 100 == 0), 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 100]
    assert sorted(got[0]) == [(k, k, 0.0) for k in range(1, 11)]
    assert sorted(got[100]) == [(k + 1, k, 1.0) for k in range(10)]
    few = neighbours.ListIndex(spark.createDataFrame([(0, [1.0]), (5, [2.0]), (9, [5.0])], schema))
    assert sorted((r.rank, r.vec_id) for r in few.search(few.rows.filter("vec_id = 0"), 10).collect()) == [(1, 5), (2, 9)]


def test_neighbours_of_far_and_crowded_vectors(spark):
    """A query beside a group of copies and one far from all still get ten, the right ones."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 8))
    x[:1000] = x[0]
    x[1000] = x[0] + 1e-6
    x[2000] = 100.0
    index = neighbours.ListIndex(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
    got = {}
    for r in index.search(index.rows.filter("vec_id IN (0, 1000, 2000)"), 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert [v for _, v in sorted(got[0])] == list(range(1, 11)) and [v for _, v in sorted(got[1000])] == list(range(10))
    d = ((x - x[2000]) ** 2).sum(1)
    assert len(set(np.argsort(d)[1:11].tolist()) & {v for _, v in got[2000]}) >= 9


def test_url_ties_repeats_and_empty_tables(spark):
    rules = [urls.Rule("b.org", "/x", "block"), urls.Rule("org", "/x/yz", "allow"), urls.Rule("b.org", "/x", "allow"), urls.Rule("b.org", "/x", "block")]
    pages = spark.createDataFrame([(1, "h://b.org/x/yz"), (1, "h://b.org/x/yz"), (None, "h://b.org/x"), (2, None), (3, ""), (4, "b.org/x")], "page_id long, url string")
    got = found(urls.judge(pages, rules), "page_id", "host", "rule", "verdict")
    assert got == sorted([(1, "b.org", "org/x/yz", "allow")] * 2 + [(None, "b.org", "b.org/x", "block"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "", None, "allow")], key=repr)
    assert urls.judge(pages.filter("false"), rules).collect() == []
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}


def test_stored_tables_can_be_dropped(spark):
    table = common.stored(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count(), "t")
    assert table.count() == 3 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    common.drop(table)
    with pytest.raises(Exception):
        spark.read.parquet(table.stored_at)


def test_pipeline_stages_with_nulls_repeats_and_nothing(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    text = given.first().text
    odd = spark.createDataFrame([(None, text, "en", "s", 1), (7, None, None, None, None), (7, "", "en", "s", 0), (8, text, "en", "s", 1), (8, text, "en", "s", 1)], given.schema)
    for docs in (given.filter("false"), odd):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert all(r.length > 0 for r in docs.collect())


def test_tables_of_the_phrase_index_do_not_grow_with_the_texts(spark, monkeypatch):
    sizes = []

    def stored(df, name):
        out = common.stored(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(leaks, "stored", stored)
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(i, f"{'one two ' * 50}{item if i % 2 else ''} end") for i in range(20)]
    got = found(leaks.contamination(frame(spark, rows), bench), "doc_id", "n_hit")
    assert got == sorted([(i, 11 * (i % 2)) for i in range(20)], key=repr)
    assert max(sizes) <= 11


def test_words_are_placed_by_splitting_a_text_once(spark):
    """Each use of the words of a text that is not planned away splits the text anew."""
    rows = [(1, "One, two ÉTÉ été Ünd"), (2, "  ,.lead 7x"), (3, "trail. "), (4, None), (5, ""), (6, " . "), (None, "Y"), (1, "other")]
    docs = leaks.keyed(frame(spark, rows))
    got = found(leaks.placed_words(docs), "doc_id", "place", "word")
    wanted = [(d, i, w) for d, t in rows for i, w in enumerate(brute.WORDS.findall(brute.lowered(t)))]
    assert got == sorted(wanted, key=repr)
    bench = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    plan = leaks.PhraseIndex(frame(spark, rows), bench).tokens._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
