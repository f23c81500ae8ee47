"""Legacy archives (ARC) and their conversion to WARC.

An ARC file begins with a version block that names the fields of its record
headers; a record is a header line, whose last field is the length of what
follows, and an HTTP response. Version 1 has five fields, version 2 ten. The
converter parses records by the fields their file declares, works out digests,
and writes WARC records: identifiers from file and offset, timestamps from the
14-digit date, ``response`` or, for a repeated payload, ``revisit`` without it.

Files are written by Spark's text writer (one file per task, gzip) and read
whole by its binary reader, so they may lie in any store.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.llm.components import stored

# Field names of the two versions' header lines.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Payloads below this are always stored.
LEAST_SHARED = 100
#: Response records of shared payloads are broadcast up to so many, beyond that joined by shuffle.
BROADCAST_SHARED = 100_000
_CHUNK = 4 << 20

_RECORD = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
     ("mime", pa.string()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("payload", pa.string())]
)
_RECORD_KINDS = "file string, offset long, page_id long, url string, ip string, date string, mime string, payload_bytes long, digest string, payload string"
_HEAD = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("refers_id", pa.string()), ("target", pa.string()), ("warc_date", pa.string())]
)
_HEAD_KINDS = "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_id string, target string, warc_date string"


def _http_head(page_id: int | None, size: int) -> str:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {size}\r\n\r\n"


def _http_fields(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if v}


def _arc_url(url: str | None) -> str:
    """No white space or control character can stand in a header line; they are percent-encoded."""
    if not url:
        return "-"
    return "".join("".join(f"%{b:02X}" for b in c.encode()) if c.isspace() or ord(c) < 33 or ord(c) == 127 else c for c in url)


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _size(text: str) -> int:
    return len(text.encode("utf-8", "replace"))


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000", ip: str = "0.0.0.0") -> None:
    """One ARC file per task from pages (page_id, url, html), in turn of version 1 and 2."""

    def run(batches):
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part:05d}.arc"
        block = f"{version} 0 fieldstats\n{ARC_FIELDS[version]}\n"
        first = f"filedesc://{name} {ip} {date} text/plain " + ("" if version == 1 else f"200 - - 0 {name} ") + f"{_size(block)}\n{block}"
        yield pa.RecordBatch.from_pydict({"value": [first]})
        offset = _size(first) + 1
        for batch in batches:
            rows, held = [], 0
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                html = html or ""
                body = _http_head(page_id, _size(html)) + html
                more = "" if version == 1 else f"200 {hashlib.sha256(_utf8(html)).hexdigest()} - {offset} {name} "
                rows.append(f"{_arc_url(url)} {ip} {date} text/html {more}{_size(body)}\n{body}")
                offset += _size(rows[-1]) + 1
                held += len(body)
                if held > _CHUNK:
                    yield pa.RecordBatch.from_pydict({"value": rows})
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pydict({"value": rows})

    pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "value string").write.option("lineSep", "\n").option(
        "compression", "gzip"
    ).text(path)


def parse_arc(content: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, body) of each record of an open ARC file, after its version block."""
    names, offset = None, 0
    while line := content.readline():
        begin, offset = offset, offset + len(line)
        if line in (b"\n", b"\r\n"):
            continue
        cells = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        body = content.read(int(cells[-1]))
        offset += len(body)
        if len(body) < int(cells[-1]):
            raise ValueError(f"record at {begin} is cut off")
        if names is None:
            version, fields = body.decode().split("\n")[:2]
            if fields != ARC_FIELDS.get(int(version.split(" ")[0])):
                raise ValueError(f"unknown version block: {version}")
            names = fields.split(" ")
            continue
        if len(cells) != len(names):
            raise ValueError(f"header line at {begin} has {len(cells)} fields, its file declares {len(names)}")
        yield begin, dict(zip(names, cells, strict=True)), body


def read_arc(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """Records of the ARC files under path; payload is null unless asked for."""

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, held = {f.name: [] for f in _RECORD}, 0
                for offset, fields, body in parse_arc(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    head, _, payload = body.partition(b"\r\n\r\n")
                    page_id = _http_fields(head).get("x-page-id")
                    values = (file.rpartition("/")[2], offset, None if page_id is None else int(page_id), fields["URL"], fields["IP-address"], fields["Archive-date"],
                              fields["Content-type"], len(payload), hashlib.sha256(payload).hexdigest(), payload.decode() if payloads else None)
                    for name, value in zip(_RECORD.names, values, strict=True):
                        rows[name].append(value)
                    held += len(payload) if payloads else 100
                    if held > _CHUNK:
                        yield pa.RecordBatch.from_pydict(rows, schema=_RECORD)
                        rows, held = {f.name: [] for f in _RECORD}, 0
                yield pa.RecordBatch.from_pydict(rows, schema=_RECORD)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RECORD_KINDS)


def _record_id(file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.blake2b(f'{file}:{offset}'.encode(), digest_size=16).digest(), version=5)}>"


def _warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _warc_record(fields: list[tuple[str, str]], block: str) -> str:
    raw = _utf8(block)
    fields = [*fields, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(raw).hexdigest()}"), ("Content-Length", str(len(raw)))]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + block


def write_warc(records: DataFrame, path: str) -> None:
    """One WARC file per task from ARC records with kept_file, kept_offset (null: a response itself)."""

    def run(batches):
        yield pa.RecordBatch.from_pydict(
            {"value": [_warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(int=TaskContext.get().partitionId())}>"), ("Content-Type", "application/warc-fields")], "format: WARC File Format 1.1\r\n")]}
        )
        for batch in batches:
            rows, held = [], 0
            for r in batch.to_pylist():
                again = r["kept_file"] is not None
                fields = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _record_id(r["file"], r["offset"])), ("WARC-Date", _warc_date(r["date"]))]
                if r["url"] != "-":
                    fields.append(("WARC-Target-URI", r["url"]))
                fields += [("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha256:{r['digest']}"), ("Content-Type", "application/http; msgtype=response")]
                if again:
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(r["kept_file"], r["kept_offset"]))]
                block = _http_head(r["page_id"], r["payload_bytes"]) + ("" if again else r["payload"])
                rows.append(_warc_record(fields, block))
                held += len(block)
                if held > _CHUNK:
                    yield pa.RecordBatch.from_pydict({"value": rows})
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pydict({"value": rows})

    records.mapInArrow(run, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse_warc(content: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open WARC file."""
    while line := content.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = {}
        while (line := content.readline()) and line.strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields["content-length"])
        block = content.read(size)
        if len(block) < size:
            raise ValueError("record is cut off")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """What the response and revisit records of the WARC files under path hold; digests of stored payloads are worked out anew."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = {f.name: [] for f in _HEAD}
                for fields, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    http = _http_fields(head)
                    stated = fields["warc-payload-digest"].removeprefix("sha256:")
                    digest = stated if kind == "revisit" else hashlib.sha256(payload).hexdigest()
                    if digest != stated:
                        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
                    size = int(http["content-length"]) if kind == "revisit" else len(payload)
                    page_id = http.get("x-page-id")
                    values = (fields["warc-record-id"], None if page_id is None else int(page_id), kind, size, digest, fields.get("warc-refers-to"),
                              fields.get("warc-target-uri"), fields["warc-date"])
                    for name, value in zip(_HEAD.names, values, strict=True):
                        rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=_HEAD)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _HEAD_KINDS)


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """ARC files to WARC files.

    Of records with equal payloads of LEAST_SHARED bytes or more the one with
    the smallest page_id (then file and offset; without page_id last) is the
    response, the others revisit it.
    """
    light = read_arc(spark, arc, False).where(F.col("payload_bytes") >= LEAST_SHARED)
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset")
    shared = light.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("kept")).where("n > 1")
    shared = stored(shared.select("digest", F.col("kept.file").alias("kept_file"), F.col("kept.offset").alias("kept_offset")), "shared-payloads")
    records = read_arc(spark, arc, True)
    told = F.broadcast(shared) if shared.count() <= BROADCAST_SHARED else shared
    own = (F.col("file") == F.col("kept_file")) & (F.col("offset") == F.col("kept_offset"))
    both = records.join(told, "digest", "left").withColumn("is_kept", F.coalesce(own, F.lit(True)))
    both = both.withColumn("kept_file", F.when(~F.col("is_kept"), F.col("kept_file"))).drop("is_kept")
    write_warc(both.withColumn("payload", F.when(F.col("kept_file").isNull(), F.col("payload"))), warc)


def resolved(records: DataFrame) -> DataFrame:
    """Read-back records with refers_to, the page_id of the response that a revisit names.

    Responses pass through with no join; only revisits meet the responses they name, so
    the many records without a key never gather in one task. Give records that are stored
    (they are read three times).
    """
    revisits = records.where(F.col("refers_id").isNotNull())
    named = revisits.select(F.col("refers_id").alias("record_id")).distinct()
    target = records.join(named, "record_id").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    plain = records.where(F.col("refers_id").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(revisits.join(target, "refers_id", "left"))
