"""Web archives: pages to WARC records and back, with segmented records and chunked transfer.

Writing: one record per page. Of pages with one payload the one with the least id is a
``response``, the others are ``revisit`` records that refer to it. A response is an HTTP message in
chunked transfer coding; a block above ``segment_bytes`` is cut into a first segment and
``continuation`` records. Files are written by Spark's own writer, so any store it reaches will do:
a record ends with two line breaks, which is the line separator of the text writer. A file is one
gzip stream.

Reading: files are parsed once, record by record by their lengths, and what was found is written.
Whole responses are decoded at once; only segments are shuffled: grouped by origin, put in order of
their numbers, checked against the total length, joined and decoded. A group is one page's segments.
Revisits then look up the record they refer to. An archive is a row of Spark's binary source, so
2 GB at most, and held uncompressed by its task; archives of this writer have ``RECORDS_PER_FILE``
records.

Defined results: a null payload is empty; a null url is left out; of rows with one least id and one
payload, the first by place is the response. ``problem`` says why a record could not be
reassembled (its payload is then null): a missing segment, a wrong total length, a bad chunk or a
missing origin; a segment that comes twice counts once. Damage costs what it hits: bytes that are no
record, a record without a usable head and one that is cut off each give a row of type ``damaged``
whose ``problem`` names it, and reading goes on at the next line that starts a record; so do a broken
gzip stream, which ends its file, and a foreign file. Records of other types are passed over. An
empty table gives no rows.
"""

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewire.llm.rows import with_row_id
from galewire.sources.scratch import materialize

SEGMENT_BYTES = 1 << 15
CHUNK_BYTES = 1 << 12
RECORDS_PER_FILE = 1 << 12
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = HTTP + b"Transfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for k in range(0, len(payload), size):
        part = payload[k : k + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("head")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))}
    return unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records(page: dict, segment_bytes: int) -> Iterator[bytes]:
    payload = page["payload"]
    own = f"<urn:uuid:{page['record']}>"
    url = page["url"].replace("\r", "").replace("\n", "") if page["url"] is not None else None
    fields = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", url),
              ("WARC-Page-ID", page["page_id"]), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if page["refers"] is not None:
        refers = ("WARC-Refers-To", f"<urn:uuid:{page['refers']}>")
        yield _record([("WARC-Type", "revisit"), *fields, refers, ("WARC-Profile", PROFILE), http], HTTP + b"\r\n")
        return
    block = CHUNKED + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *fields, http], block)
        return
    n = -(-len(block) // segment_bytes)
    for k in range(n):
        part = block[k * segment_bytes : (k + 1) * segment_bytes]
        number = ("WARC-Segment-Number", k + 1)
        if k == 0:
            yield _record([("WARC-Type", "response"), *fields, number, http], part)
            continue
        yield _record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{k + 1}>"), ("WARC-Date", DATE),
             ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own), number,
             ("WARC-Segment-Total-Length", len(block) if k == n - 1 else None)],
            part,
        )


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    least_bytes: int = LEAST_BYTES,
) -> None:
    named = with_row_id(pages).select(
        F.col(f"row.`{page_id}`").cast("string").alias("page_id"),
        F.col(f"row.`{page_id}`").isNull().alias("_null"),
        F.col(f"row.`{page_id}`").alias("_id"),
        F.col(f"row.`{url}`").alias("url"),
        F.coalesce(F.col(f"row.`{payload}`"), F.lit("")).cast("binary").alias("payload"),
        F.md5(F.to_json(F.struct("rid"))).alias("record"),
        "rid",
    )
    # Digests only: a payload that many pages share, such as an empty one, meets in no task.
    digests = materialize(
        named.select("record", "rid", "_null", "_id", F.sha1("payload").alias("_sha"), F.length("payload").alias("_n")),
        "warc-digests",
    ).filter(F.col("_n") >= least_bytes)
    origins = (
        digests.groupBy("_sha")
        .agg(F.count("*").alias("_n"), F.min(F.struct("_null", "_id", "rid", "record")).alias("_first"))
        .filter("_n > 1")
        .select("_sha", F.col("_first.record").alias("refers"))
    )
    again = digests.join(origins, "_sha").filter("refers <> record").select("record", "refers")
    marked = named.join(again, "record", "left").select("page_id", "url", "payload", "record", "refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for k in range(batch.num_rows):
                page = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                for record in records(page, segment_bytes):
                    out.append(record)
                    size += len(record)
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # The bytes of a record are written as they are, whatever they hold.
    lines = marked.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


PARSED = (
    "record string, type string, page_id string, refers string, number int, total long, block binary, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)
_COLUMNS = [x.split()[0] for x in PARSED.split(", ")]


def _decoded(block: bytes, with_payload: bool) -> dict:
    try:
        payload = http_payload(block)
    except ValueError:
        return {"problem": "bad chunk"}
    return {"payload_bytes": len(payload), "payload_digest": sha1_base32(payload),
            "payload": payload if with_payload else None}


class Damaged(ValueError):
    """Why no record could be read here."""


def _one(stream: io.BytesIO, line: bytes) -> tuple[dict[str, str], bytes]:
    """The record whose first line was read."""
    fields = {}
    while (head := stream.readline()) not in (b"\r\n", b"\n", b""):
        key, _, value = head.decode("utf-8", "replace").partition(":")
        fields[key.strip().lower()] = value.strip()
    try:
        size = int(fields["content-length"])
        number = fields.get("warc-segment-number")
        usable = size >= 0 and "warc-type" in fields and "warc-record-id" in fields and (number is None or int(number) > 0)
        int(fields.get("warc-segment-total-length") or 0)
    except (KeyError, ValueError):
        usable = False
    if not usable:
        raise Damaged("bad record head")
    block = stream.read(size)
    if len(block) < size or stream.read(4) != END.encode():
        raise Damaged("record cut off")
    return fields, block


def _unzipped(content: bytes) -> tuple[bytes, bool]:
    """What a file of gzip members holds, as far as it can be read, and whether that is all."""
    out, inner = [], zlib.decompressobj(31)
    for k in range(0, len(content), 1 << 16):
        part = content[k : k + (1 << 16)]
        while part:
            if inner.eof:
                inner = zlib.decompressobj(31)
            try:
                out.append(inner.decompress(part))
            except zlib.error:
                return b"".join(out), False
            part = inner.unused_data.lstrip(b"\0") if inner.eof else b""
    return b"".join(out), inner.eof


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes] | str]:
    """Records, and for each damaged place its problem."""
    whole = True
    if content[:2] == b"\x1f\x8b":
        content, whole = _unzipped(content)
    stream, lost = io.BytesIO(content), False
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if not lost and line.strip():
                yield "no WARC record"
                lost = True
            continue
        mark = stream.tell()
        try:
            yield _one(stream, line)
            lost = False
        except Damaged as why:
            yield str(why)
            # The length cannot be trusted: look for a record from the next line on.
            stream.seek(mark)
            lost = True
    if not whole:
        yield "broken gzip stream"


def _bare(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:uuid:").removesuffix(">") if urn else None


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in PARSED.split(", "))])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row.get("block") or b"") + len(row.get("payload") or b"")
        if size > 1 << 23:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per response, revisit and damaged place: ``record``, ``type``, ``page_id``, ``refers``,
    ``payload_bytes``, ``payload_digest``, ``payload`` and ``problem``; a revisit's own payload is
    empty."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for content in batch.column("content"):
                    for found in _parse(content.as_py()):
                        if isinstance(found, str):
                            yield {"type": "damaged", "problem": found}
                            continue
                        f, block = found
                        if f["warc-type"] not in ("response", "revisit", "continuation"):
                            continue
                        number = int(f["warc-segment-number"]) if "warc-segment-number" in f else None
                        total = f.get("warc-segment-total-length")
                        row = {
                            "record": _bare(f.get("warc-segment-origin-id") or f["warc-record-id"]),
                            "type": f["warc-type"], "page_id": f.get("warc-page-id"),
                            "refers": _bare(f.get("warc-refers-to")), "number": number,
                            "total": int(total) if total else None,
                        }
                        if number is None and f["warc-type"] == "continuation":
                            yield {"type": "damaged", "problem": "bad record head"}
                        elif number is None and f["warc-type"] == "response":
                            yield row | _decoded(block, with_payload)
                        else:
                            yield row | {"block": block}

        return _batches(rows())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    parts = {p["number"]: p for p in row["parts"]}
                    first, last = parts.get(1), parts[max(parts)]
                    out = {"record": row["record"], "type": "response",
                           "page_id": first["page_id"] if first else None}
                    block = b"".join(parts[k]["block"] for k in sorted(parts))
                    if not first or last["total"] is None or len(parts) != max(parts):
                        yield out | {"problem": "missing segment"}
                    elif len(block) != last["total"]:
                        yield out | {"problem": "wrong total length"}
                    else:
                        yield out | _decoded(block, with_payload)

        return _batches(rows())

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = materialize(files.mapInArrow(parse, PARSED), "warc-parsed")
    segments = (
        parsed.filter("number IS NOT NULL")
        .groupBy("record")
        .agg(F.collect_list(F.struct("number", "total", "page_id", "block")).alias("parts"))
    )
    whole = parsed.filter("number IS NULL").unionByName(segments.mapInArrow(join, PARSED))
    return whole.select(*[c for c in _COLUMNS if c not in ("number", "total", "block")])


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with each revisit's payload facts taken from the record it refers to, and that
    record's page in ``refers_to``."""
    origin = records.filter("type = 'response'").select(
        F.col("record").alias("refers"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"),
        F.coalesce("problem", F.lit("")).alias("_problem"),
    )
    own = records.filter("type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("string"))
    again = records.filter("type = 'revisit'").join(origin, "refers", "left").select(
        *[c for c in records.columns if c not in ("payload_bytes", "payload_digest", "problem")],
        F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"),
        F.when(F.col("_problem").isNull(), F.lit("missing origin"))
        .when(F.col("_problem") != "", F.col("_problem")).alias("problem"),
        "refers_to",
    )
    return own.unionByName(again)
