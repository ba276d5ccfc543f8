"""Web archives: legacy ARC files, their conversion to WARC, and reading both back.

Files are written by Spark's text writer, one row for each record, and read whole by its binary reader, so that any store
that Spark reaches will do. The separator after a row is the format's own (a line feed in ARC, two line ends in WARC).
Every file starts with a record that describes it: a task puts one before every ``RECORDS - 1`` records, and the
writer starts a new file after ``RECORDS``. Readers go by declared lengths alone, never by separators.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import common
from tableferry.sources.storage import scratch_directory

#: Records of a file with the one that describes it.
RECORDS = 1_000
#: Of equal payloads of at least so many bytes all but one become revisits.
LEAST_BYTES = 0
#: Archive date of pages, which have none of their own.
DATE = "20000101000000"

#: The header fields of ARC versions 1 and 2.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
#: Fixed value: the profile of a revisit record.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _address(url: str | None) -> str:
    """A url without blanks, controls and characters beyond ASCII, which header lines can't hold."""
    return urllib.parse.quote(url, safe="".join(map(chr, range(33, 127)))) if url else "about:blank"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _write(frame: DataFrame, path: str, separator: str) -> None:
    text = frame.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", separator).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """``file`` (its name) and ``content`` of each archive in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _described(records: Iterator[bytes], describe) -> Iterator[pa.RecordBatch]:
    """Batches of records with a describing one before every ``RECORDS - 1`` of them."""
    held, number, size = [], 0, 0
    for record in records:
        if number % (RECORDS - 1) == 0:
            held.append(describe(number))
        number += 1
        held.append(record)
        size += len(record)
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])


# --- ARC -----------------------------------------------------------------------------------------------------------


def _arc_line(version: int, values: dict[str, object]) -> bytes:
    return " ".join(str(values.get(x, "-")) for x in FIELDS[version]).encode() + b"\n"


def _arc_description(version: int, name: str) -> bytes:
    body = f"{version} 0 tableferry\n{' '.join(FIELDS[version])}\n".encode()
    head = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": DATE, "Content-type": "text/plain", "Archive-length": len(body)}
    return _arc_line(version, head | {"Result-code": 200, "Offset": 0, "Filename": name}) + body


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC files; the version is 1 or 2 in turn by page. Null html counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records(version: int) -> Iterator[bytes]:
            for batch in batches:
                for page, url, text in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = (text or "").encode("utf-8", "surrogatepass")
                    own = "" if page is None else f"X-Page-Id: {page}\r\n"
                    http = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode()
                    body = http + payload
                    values = {"URL": _address(url), "IP-address": "0.0.0.0", "Archive-date": DATE, "Content-type": "text/html", "Archive-length": len(body)}
                    if version == 2:
                        values |= {"Result-code": 200, "Checksum": hashlib.md5(payload).hexdigest(), "Offset": 0, "Filename": "pages.arc"}
                    yield _arc_line(version, values) + body

        # The version follows from the first page of the task, so that a repeated task writes the same.
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        version = 1 + (first.column(0)[0].as_py() or 0) % 2
        rest = batches

        def chained() -> Iterator[pa.RecordBatch]:
            yield first
            yield from rest

        batches = chained()
        yield from _described(records(version), lambda n: _arc_description(version, f"pages-{n}.arc"))

    _write(pages.select("page_id", "url", "html").mapInArrow(run, "value binary"), path, "\n")


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, network document) of each record. The version block in force names the fields."""
    at, fields = 0, None
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line at {at} has no end")
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"ARC header line at {at} declares no length: {values!r}")
        start, stop = end + 1, end + 1 + int(values[-1])
        if stop > len(data):
            raise ValueError(f"ARC record at {at} is shorter than it declares")
        body = data[start:stop]
        if values[0].startswith("filedesc://"):
            fields = body.decode("utf-8", "replace").splitlines()[1].split(" ")
        else:
            if fields is None:
                raise ValueError("an ARC file must start with its version block")
            extra = len(values) - len(fields)  # a url may hold blanks: the other fields count from the end
            yield at, dict(zip(fields, [" ".join(values[: 1 + extra]), *values[1 + extra :]])), body
        at = stop


def _http(document: bytes) -> tuple[bytes, bytes]:
    """Head (with its empty line) and payload of an HTTP response."""
    end = document.find(b"\r\n\r\n")
    return (document[: end + 4], document[end + 4 :]) if end >= 0 else (document, b"")


def _field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


_ARC = "file string, at long, page_id long, url string, ip string, date string, payload_bytes long, sha1 string, sha256 string, head binary, payload binary"


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of a folder of ARC files; ``file`` and ``at`` identify one. Without payloads the digests stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _ARC.split(", "))])
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for at, header, document in parse_arc(gzip.decompress(content.as_buffer())):
                    head, payload = _http(document)
                    page = _field(head, b"x-page-id")
                    rows.append(
                        (file, at, int(page) if page else None, header["URL"], header["IP-address"], header["Archive-date"], len(payload), digest(payload), hashlib.sha256(payload).hexdigest())
                        + ((head, payload) if payloads else (None, None))
                    )
                    size += len(document) if payloads else 100
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return _read(spark, path).mapInArrow(run, _ARC)


# --- conversion ----------------------------------------------------------------------------------------------------


def _record_id(url: str, date: str, file: str, at: int) -> str:
    """The same record gets the same identifier whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {file} {at}')}>"


def _warc_date(date: str) -> str:
    date = (date + "00000101000000"[len(date) :])[:14]
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _warc(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", len(block))] if v is not None)
    return f"WARC/1.0\r\n{lines}\r\n".encode() + block


def _warc_info(number: int, name: str) -> bytes:
    block = b"software: tableferry\r\nformat: WARC File Format 1.0\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name, DATE, "info", number)), ("WARC-Date", _warc_date(DATE)), ("WARC-Filename", f"{name}-{number}.warc")]
    return _warc([*fields, ("Content-Type", "application/warc-fields")], block)


def revisits(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``file, at`` of the records that repeat a payload, with the record they refer to.

    Of equal payloads the record with the largest page_id is the response (of repeated rows the first by file and
    place; a null page_id comes last). Digests of two kinds and the length tell payloads apart.
    """
    key = F.concat_ws(":", "sha256", "sha1", F.col("payload_bytes").cast("string"))
    keyed = common.stored(records.filter(F.col("payload_bytes") >= least_bytes).select("file", "at", "page_id", "url", "date", key.alias("key")), "digests")
    last = F.max_by(F.struct("file", "at", "url", "date"), F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), "file", (-F.col("at")).alias("at")))
    groups = keyed.groupBy("key").agg(F.count("*").alias("rows"), last.alias("to")).filter("rows > 1")
    found = common.join_counted(keyed, common.stored(groups, "groups"), "key", "rows", max(1, keyed.count()))
    same = (F.col("file") == F.col("to.file")) & (F.col("at") == F.col("to.at"))
    return found.filter(~same).select("file", "at", "to")


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = LEAST_BYTES) -> None:
    """A folder of ARC files as WARC files: identifiers, dates, types and digests follow from the ARC headers."""
    repeats = common.stored(revisits(read_arc(spark, arc, payloads=False), least_bytes), "revisits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name: list[str] = []

        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in batch.to_pylist():
                    if not name:
                        name.append(f"{row['file']}-{row['at']}")
                    to = row["to"]
                    fields: list[tuple[str, object]] = [
                        ("WARC-Type", "revisit" if to else "response"),
                        ("WARC-Record-ID", _record_id(row["url"], row["date"], row["file"], row["at"])),
                        ("WARC-Date", _warc_date(row["date"])),
                        ("WARC-Target-URI", row["url"]),
                        ("WARC-IP-Address", row["ip"]),
                        ("WARC-Payload-Digest", f"sha1:{row['sha1']}"),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    if to:
                        fields += [
                            ("WARC-Profile", PROFILE),
                            ("WARC-Refers-To", _record_id(to["url"], to["date"], to["file"], to["at"])),
                            ("WARC-Refers-To-Target-URI", to["url"]),
                            ("WARC-Refers-To-Date", _warc_date(to["date"])),
                        ]
                    yield _warc(fields, row["head"] if to else row["head"] + row["payload"])

        yield from _described(records(), lambda n: _warc_info(n, name[0] if name else "archive"))

    joined = read_arc(spark, arc).join(repeats, ["file", "at"], "left")
    _write(joined.mapInArrow(run, "value binary"), warc, "\r\n\r\n")


# --- WARC ----------------------------------------------------------------------------------------------------------


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-cased names) and block of each record; a block whose digest is wrong raises."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = end + 4 + int(fields["content-length"])
        block = data[end + 4 : at]
        if at > len(data) or fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
            raise ValueError(f"damaged WARC record {fields.get('warc-record-id')}")
        yield fields, block


_WARC = "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, payload_digest string, to_id string, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of a folder of WARC files. A revisit's length is that of the payload it stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _WARC.split(", "))])
        for batch in batches:
            for content in batch.column(1):
                rows, size = [], 0
                for fields, block in parse_warc(gzip.decompress(content.as_buffer())):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = _http(block)
                    own = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != own:
                        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
                    page = _field(head, b"x-page-id")
                    length = len(payload) if kind == "response" else int(_field(head, b"content-length") or 0)
                    rows.append(
                        (fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields.get("warc-date"), int(page) if page else None, length, own)
                        + (fields.get("warc-refers-to"), payload if payloads and kind == "response" else None)
                    )
                    size += len(block) if payloads else 100
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return _read(spark, path).mapInArrow(run, _WARC)


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages through ARC files, the converter and WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row for each page. Null html is an empty payload, and all empty payloads are equal; a null url is
    ``about:blank``; a null page_id stays null. Repeated rows are records of their own, of which one is the response.
    An empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    root = f"{scratch_directory(spark)}/archives"
    write_arc(pages, f"{root}/arc")
    convert(spark, f"{root}/arc", f"{root}/warc", least_bytes)
    records = common.stored(read_warc(spark, f"{root}/warc", payloads=False).drop("payload", "url", "date"), "records")
    repeats = records.filter("to_id is not null").groupBy("to_id").agg(F.count("*").alias("rows"))
    sources = records.filter("record_type = 'response'").select(F.col("record_id").alias("to_id"), F.col("page_id").alias("refers_to"))
    sources = common.stored(repeats.join(sources, "to_id"), "sources")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.filter("to_id is null").select(*out, F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(common.join_counted(records.filter("to_id is not null"), sources, "to_id", "rows", max(1, records.count())).select(*out, "refers_to"))
