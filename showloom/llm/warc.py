"""WARC archives: written by Spark with a gzip member for each record, read back in byte ranges.

Reading: Spark's text source is told that a line ends where the gzip magic begins. So each task scans its byte range for the
magic and gets, in order, what stands between two of them, owning those that start inside its range, wherever they end.
The magic may also stand in compressed data: a candidate whose header cannot be a member's, or whose data do not begin
with a WARC version, is joined to the record in front of it. Where that one starts in an
earlier range, both are put together by file. (Records of another archive that stand uncompressed in a
payload are told from its own by the member around them, unless a range begins in between.)

Writing: the text sink puts one byte behind each row. That byte is 0, the last byte of a member's length
field; members of 16 MiB or more get an empty member behind them, which ends in 0. So archives have Spark's commit protocol
and may lie wherever Spark writes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are stored again each time.
LEAST_REVISIT = 1000
#: Payload bytes put out or compressed at once.
BYTES_AT_ONCE = 1 << 24

_GZIP = 31  # zlib's number for the gzip format
_VERSION = b"WARC/"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def _response_id(sha1: str) -> str:
    """The record that revisits of this payload refer to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, sha1)}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, kind: str, shared: bool) -> bytes:
    """One record; a revisit has the header of the HTTP answer only and refers to the response of its digest."""
    head = [("WARC-Type", kind), ("WARC-Date", "1970-01-01T00:00:00Z")]
    response = _response_id(sha1)
    if kind == "response" and shared:
        head.append(("WARC-Record-ID", response))
    else:
        head.append(("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"))
    if kind == "revisit":
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", response)]
    if url is not None:
        head.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    block = _HTTP.format(len(payload)).encode() + (payload if kind == "response" else b"")
    head += [
        ("WARC-Payload-Digest", "sha1:" + _base32(sha1)), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose last byte is 0, with an empty one behind it where needed."""
    z = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
    out = z.compress(data) + z.flush()
    return out if out[-1] == 0 else out + member(b"")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "html", BYTES_AT_ONCE):
            columns = [part.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "kind", "shared")]
            out = [
                member(record(p, u, h.encode(), s, k, x))[:-1] for p, u, h, s, k, x in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.large_binary())], names=["member"])


def _with_digest(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(F.encode(html, "UTF-8")).alias("sha1"),
    )


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``pages(page_id, url, html)`` in a new folder: a record for each row.

    Of rows with equal payloads of at least 1000 bytes that with the largest ``page_id`` (then the largest url; null is
    least) is a response, the others are revisits of it. Rows equal in all three columns cannot be told
    apart: one of them is the response. A null html is an empty payload, and a null id or url is left out.
    """
    rows = _with_digest(pages)
    long = rows.filter(F.octet_length("html") >= LEAST_REVISIT)
    counts = long.groupBy("sha1", "page_id", "url").agg(F.count("*").alias("n"))
    most = F.max(F.struct("page_id", "url", "n")).alias("kept")
    copied = stored(counts.groupBy("sha1").agg(F.sum("n").alias("copies"), most).filter("copies > 1"), "copied")

    # Spark sends the digests to all tasks if their table is small, else both sides are sorted and hot digests divided
    kept = copied.select("sha1", F.col("kept.page_id").alias("k_id"), F.col("kept.url").alias("k_url"), F.col("kept.n").alias("k_n"))
    marked = rows.join(kept, "sha1", "left")
    first = F.col("page_id").eqNullSafe(F.col("k_id")) & F.col("url").eqNullSafe(F.col("k_url"))
    repeated = copied.filter("kept.n > 1").count() > 0
    columns = ["page_id", "url", "html", "sha1", "kind", "shared"]
    shared = F.col("k_n").isNotNull()
    kind = F.when(shared & ~first, "revisit").otherwise("response")
    out = marked.withColumn("shared", shared).withColumn("kind", kind)
    if repeated:
        same = F.col("shared") & first & (F.col("k_n") > 1)
        alike = out.filter(same).groupBy("page_id", "url", "sha1").agg(F.first("html").alias("html"), F.count("*").alias("n"))
        each = alike.select("page_id", "url", "html", "sha1", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
        kinds = F.when(F.col("i") == 1, "response").otherwise("revisit")
        one_by_one = each.select("page_id", "url", "html", "sha1", kinds.alias("kind"), F.lit(True).alias("shared"))
        out = out.filter(~same).select(*columns).unionByName(one_by_one)
    members = out.select(*columns).mapInArrow(_members, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def _starts_record(candidate: bytes) -> bool:
    """Whether a member begins here: a possible header, and data that begin with a WARC version."""
    if len(candidate) < 18 or candidate[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(_GZIP).decompress(candidate[:4096], len(_VERSION)) == _VERSION
    except zlib.error:
        return False


def _decoded(data: bytes) -> tuple[bytes | None, bool]:
    """The contents of a member (null if it is not whole), and whether more bytes could make it whole."""
    z = zlib.decompressobj(_GZIP)
    try:
        out = z.decompress(data)
    except zlib.error:
        return None, False
    return (out, False) if z.eof else (None, True)


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parsed(data: bytes | None) -> tuple:
    """Type, record id, url, page id, payload, digest and reference of a record; type ``damaged`` if it cannot be read."""
    head, found, rest = (data or b"").partition(b"\r\n\r\n")
    if not found:
        return "damaged", None, None, None, None, None, None
    fields = _headers(head)
    block = rest[: int(fields.get("content-length", "0"))]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    kind = fields.get("warc-type")
    if kind == "revisit":
        label, _, value = fields.get("warc-payload-digest", "").partition(":")
        digest = base64.b32decode(value).hex() if label == "sha1" and len(value) == 32 else value or None
    else:
        digest = hashlib.sha1(payload).hexdigest()
    page = fields.get("page-id")
    return (
        kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), int(page) if page else None,
        None if kind == "revisit" else payload, digest, fields.get("warc-refers-to"),
    )


RECORDS = (
    "record_type string, record_id string, url string, page_id long, payload binary, payload_bytes long, payload_digest string, "
    "refers_to string"
)
_PARTS = RECORDS + ", file string, at long, place int, part binary"
_BINARY = {"payload": pa.binary(), "part": pa.binary(), "place": pa.int32(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "at": pa.int64()}
_NAMES = [f.split()[0] for f in _PARTS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, _BINARY.get(n, pa.string())) for c, n in zip(zip(*rows, strict=True), _NAMES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _record_row(data: bytes | None, payloads: bool) -> tuple:
    kind, name, url, page, payload, digest, refers = parsed(data)
    size = None if payload is None else len(payload)
    return kind, name, url, page, payload if payloads else None, size, digest, refers, None, None, None, None


def _part_row(file: str, at: int, place: int, part: bytes) -> tuple:
    return *[None] * 8, file, at, place, part


def _split_reader(payloads: bool):
    """Records out of the pieces between magics; what may belong to a record over the range's border comes as parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        where: tuple | None = None  # file and range
        held: list[bytes] = []  # a record and the false candidates behind it
        begun, place = False, 0  # whether a record has begun in this range; parts put out of it

        def part():
            nonlocal place
            place += 1
            out.append(_part_row(*where, place, b"".join(held)))

        def end_of_range():
            data = _decoded(b"".join(held))[0] if begun else None
            if data is not None:
                out.append(_record_row(data, payloads))
            elif held:
                part()

        for batch in batches:
            files, ats = batch.column("file").to_pylist(), batch.column("at").to_pylist()
            for value, file, at in zip(batch.column("value"), files, ats, strict=True):
                if where != (file, at):
                    end_of_range()
                    where, held, begun, place = (file, at), [], False, 0
                piece = value.as_py()
                if not piece and not held and at == 0:
                    continue  # in front of a file's first member
                candidate = MAGIC + piece
                starts = _starts_record(candidate)
                if starts and begun:
                    data, short = _decoded(b"".join(held))
                    # a whole record of another archive may stand in a payload that could not be compressed
                    starts = data is not None or not short or _broken(held, candidate)
                    if starts:
                        out.append(_record_row(data, payloads))
                elif starts and held:
                    part()
                held, begun = ([candidate], True) if starts else ([*held, candidate], begun)
                size += len(piece)
                if size > BYTES_AT_ONCE and out:
                    yield _batch(out)
                    out, size = [], 0
        end_of_range()
        if out:
            yield _batch(out)

    return run


def _broken(held: list[bytes], candidate: bytes) -> bool:
    """Whether a member that is not whole cannot go on with the candidate, having been cut off."""
    data, short = _decoded(b"".join([*held, candidate]))
    return data is None and not short


def _joined(payloads: bool):
    """Records that stand in several ranges of a file, out of their parts in order."""

    def run(key, table):
        rows = sorted(table.select(["at", "place", "part"]).to_pylist(), key=lambda r: (r["at"], r["place"]))
        groups: list[list[bytes]] = []
        for r in rows:
            if not groups or _starts_record(r["part"]):
                groups.append([])
            groups[-1].append(r["part"])
        contents = (_decoded(b"".join(g))[0] for g in groups)
        out = [_record_row(data, payloads)[:8] for data in contents if data != b""]  # an empty member is no record
        if not out:
            return pa.Table.from_batches([], pa.schema([(n, _BINARY.get(n, pa.string())) for n in _NAMES[:8]]))
        arrays = [pa.array(c, _BINARY.get(n, pa.string())) for c, n in zip(zip(*out, strict=True), _NAMES, strict=False)]
        return pa.Table.from_arrays(arrays, names=_NAMES[:8])

    return run


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives at ``path``, each read by the task in whose byte range it starts.

    Columns: ``record_type`` (as written, or ``damaged`` for a member that is cut off or broken), ``record_id``, ``url``,
    ``page_id``, ``payload`` (null for revisits, or without ``payloads``), ``payload_bytes``, ``payload_digest`` (lowercase
    hex SHA-1, computed; of revisits as stated), ``refers_to`` (a record id). Files must not have a name that Spark decompresses.
    """
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    found = lines.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
    ).mapInArrow(_split_reader(payloads), _PARTS)
    whole = stored(found, "records")
    columns = _NAMES[:8]
    over = whole.filter("part IS NOT NULL").groupBy("file").applyInArrow(_joined(payloads), RECORDS)
    return whole.filter("part IS NULL").select(*columns).unionByName(over)


def resolved(records: DataFrame) -> DataFrame:
    """Page records with the size of the payload a revisit refers to, and the page id of that response."""
    responses = records.filter("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"))
    revisits = records.filter("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "refers_to")
    answered = revisits.join(named, "refers_to", "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    ).unionByName(answered.select("page_id", F.col("to_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("to_page").alias("refers_to")))


def archived(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` written to archives in the shared folder and read back: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` (page id of the response). See ``write`` for nulls and repeated rows; an empty
    table gives no rows; other columns are ignored."""
    spark = pages.sparkSession
    path = shared_folder(spark, "archives")
    write(pages, path)
    return resolved(read(spark, path, payloads=False))
