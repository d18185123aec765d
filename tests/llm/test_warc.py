"""Archives written and read back, and archives made by hand, read in byte ranges of all sizes."""

import gzip
import hashlib
import random
import zlib

import pytest

from showloom.llm import warc

SCHEMA = "page_id long, url string, html string, kind string, sha1 string, n long"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "s", 1) for r in rows], SCHEMA)


def plain(rows):
    ranked = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True)
    first, out = {}, []
    for page, _, html in ranked:
        raw = (html or "").encode()
        long = len(raw) >= 1000
        kind, to = ("revisit", first[raw]) if long and raw in first else ("response", None)
        if long:
            first.setdefault(raw, page)
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), kind, to))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def pages(seed=1, n=150):
    rng = random.Random(seed)
    bodies = ["", None, "x" * 999, "y" * 1000, "é" * 500, "z" * 400, "<p>\r\n\r\n</p>" * 200]
    bodies += ["".join(rng.choice("abcdefgh é\n") for _ in range(rng.choice([10, 1500, 5000]))) for _ in range(30)]
    rows = [(i, f"http://e.org/{i}", rng.choice(bodies)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_round_trip(spark):
    rows = pages()
    assert got(warc.archived(frame(spark, rows).repartition(3))) == plain(rows)
    assert sum(r[3] == "revisit" for r in plain(rows)) > 40


def test_odd_rows(spark):
    long = "m" * 3000
    rows = [(None, None, None), (None, "u", long), (None, "u", long), (3, "a\r\nb", long), (3, "b", long), (3, "b", long), (2, None, long)]
    rows += [(5, "u", long + "!")] * 4 + [(6, "u", "s")] * 3 + [(None, None, long + "?"), (None, None, long + "?")]
    assert got(warc.archived(frame(spark, rows))) == plain(rows)


def test_empty(spark):
    assert got(warc.archived(frame(spark, []))) == []


def test_a_record_longer_than_a_length_field_holds_in_three_bytes(spark):
    rng = random.Random(2)
    page = "".join(rng.choice("abcdefghij") for _ in range(1000)) * 17_500
    rows = [(1, "u", page), (2, "u", "short"), (3, "v", page)]
    assert got(warc.archived(frame(spark, rows).coalesce(1))) == plain(rows)
    data = warc.member(b"x" * (1 << 24))
    assert data[-1] == 0 and gzip.decompress(data) == b"x" * (1 << 24)


def test_files_are_plain_archives(spark, tmp_path):
    rows = pages(3, 40)
    warc.write(frame(spark, rows).coalesce(2), f"file://{tmp_path}/a")
    parts = list((tmp_path / "a").glob("part-*"))
    texts = b"".join(gzip.decompress(p.read_bytes()) for p in parts)
    assert texts.count(b"WARC/1.1\r\nWARC-Type:") == 40
    back = {r.page_id: r for r in warc.read(spark, f"file://{tmp_path}/a").collect()}
    assert all(back[i].url == u for i, u, _ in rows)
    assert all(back[i].payload is None or bytes(back[i].payload) == (h or "").encode() for i, _, h in rows)


def by_hand(payload, level):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


@pytest.mark.parametrize("size", [7, 64, 500, 1 << 20])
def test_ranges_and_false_candidates(spark, tmp_path, size):
    """Stored (uncompressed) payloads full of the magic, of whole members that are no records, and next to borders."""
    rng = random.Random(5)
    bits = [warc.MAGIC, warc.MAGIC[:2], warc.MAGIC[:1], b"text ", gzip.compress(b"not a record"), bytes(range(256)), warc.MAGIC + b"\x00" * 20]
    payloads = [b"".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(60)]
    payloads.append(warc.MAGIC * 400)
    data = b"".join(by_hand(p, rng.choice([0, 0, 6])) for p in payloads)
    (tmp_path / "made.warc").write_bytes(data)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        if size == 7:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(data) // 150))
        rows = warc.read(spark, f"file://{tmp_path}/made.warc").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(bytes(r.payload) for r in rows) == sorted(payloads)
    assert {r.payload_digest for r in rows} == {hashlib.sha1(p).hexdigest() for p in payloads}


def test_nested_archives_and_damage(spark, tmp_path):
    inner = by_hand(b"inner", 6) * 3
    data = by_hand(b"a" + inner + b"z", 0) + by_hand(b"cut off", 0)[:-30] + by_hand(b"whole", 6) + by_hand(b"end", 6)[:-4]
    (tmp_path / "made.warc").write_bytes(data)
    rows = warc.read(spark, f"file://{tmp_path}/made.warc").collect()
    assert [(r.record_type, r.payload and bytes(r.payload)) for r in sorted(rows, key=lambda r: (r.record_type, len(r.payload or b"")))] == [
        ("damaged", None), ("damaged", None), ("response", b"whole"), ("response", b"a" + inner + b"z"),
    ]
