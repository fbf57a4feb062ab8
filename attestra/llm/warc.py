"""WARC archives: written with revisits, segments and chunked framing, and read back whole.

Writing: pages of equal payloads are found by digest with a partial aggregation; the one
with the largest id is the response, the others revisit it.  A block over
``segment_bytes`` is split in a first record and continuations.  Records go through
Spark's own text writer (a record's closing blank lines are the line separator), so any
file system works; files hold at most ``records_per_file`` records.

Reading: archives are parsed in one pass.  Segments are grouped by their origin's
identifier, put in the order of their numbers, checked against the total length and
joined; chunked transfer framing is decoded; payload digests are recomputed; revisits
take their payload's size from the record they refer to.
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

from ..shipping import ship
from ..scratch import Scratch

END = b"\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def chunked(payload: bytes, size: int) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (min(size, len(payload) - i), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("chunk size is cut off")
        digits = body[at:eol].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("chunk size is no number")
        size = int(digits, 16)
        at = eol + 2
        if not size:
            # trailer fields may follow, then an empty line ends the body
            if body[at : at + 2] != b"\r\n" and not body[at:].endswith(END):
                raise ValueError("last chunk is cut off")
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its closing blank lines, which the writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def page_records(row: int, page_id: object, url: str, payload: bytes, digest: str, refers: object, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page; ``refers`` is the page id of the response that it revisits."""
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    me = record_id(page_id, digest)
    # a line break or control character in a url would end the header
    url = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    name = [("WARC-Record-ID", me), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", sha), ("X-Page", page_id), ("X-Row", row), ("Content-Type", "application/http;msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers is not None:
        yield _record([("WARC-Type", "revisit"), *name, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, digest))], head)
        return
    block = head + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *name], block)
        return
    count = -(-len(block) // segment_bytes)
    yield _record([("WARC-Type", "response"), *name, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for k in range(1, count):
        part = block[k * segment_bytes : (k + 1) * segment_bytes]
        own = f"<urn:uuid:{uuid.uuid5(_SPACE, f'{me}:{row}:{k}')}>"
        last = [("WARC-Segment-Total-Length", len(block))] if k == count - 1 else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", date), ("X-Row", row), ("WARC-Segment-Origin-ID", me), ("WARC-Segment-Number", k + 1), *last], part)


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_revisit: int = 1000,
    segment_bytes: int = 32 << 10,
    chunk_bytes: int = 8 << 10,
    date: str = "2020-01-01T00:00:00Z",
    records_per_file: int = 4096,
) -> None:
    """Write ``pages`` as gzip-compressed WARC files under ``path``, a record or more each.

    A null html is an empty payload, a null url an empty one.  Equal payloads of at least
    ``least_revisit`` bytes share the response of the largest id; rows with that id are all
    responses.  A null id is never larger than another.  An empty table writes no records.
    """
    s = Scratch(pages.sparkSession, "revisits")
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # SHA-1 has known collisions of equal size, so SHA-256 goes into the key as well
    rows = rows.withColumn("strong", F.when(F.col("size") >= least_revisit, F.sha2("payload", 256)))
    same = rows.filter(F.col("size") >= least_revisit).groupBy("digest", "size", "strong").agg(F.max("page_id").alias("keeper"), F.count("*").alias("c"))
    same = s.table(same.filter("c > 1").drop("c"))  # written, so that the join can split a payload that very many pages share
    ready = rows.join(same, ["digest", "size", "strong"], "left").withColumn("refers", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")))
    ready = ready.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "payload", "digest", "refers")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes] = []
            held = 0
            for r in (r for k in range(0, b.num_rows, 64) for r in b.slice(k, 64).to_pylist()):
                for record in page_records(r["row"], r["page_id"], r["url"], r["payload"], r["digest"], r["refers"], date, segment_bytes, chunk_bytes):
                    out.append(record)
                    held += len(record)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = ready.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(stream: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(header fields, block) of each record of a gzip-compressed archive, decompressed piece by piece."""
    inflate, buffer, at = zlib.decompressobj(31), bytearray(), 0
    source = memoryview(stream)
    done = 0

    def more() -> bool:
        nonlocal done, at, inflate
        del buffer[:at]
        at = 0
        while done < len(source):
            piece = bytes(source[done : done + (1 << 18)])
            done += len(piece)
            got = inflate.decompress(piece)
            if inflate.eof and inflate.unused_data:  # archives with a gzip member a record
                done -= len(inflate.unused_data)
                inflate = zlib.decompressobj(31)
            if got:
                buffer.extend(got)
                return True
        return False

    while True:
        while (end := buffer.find(END, at)) < 0:
            if not more():
                if buffer[at:].strip():
                    raise ValueError("archive is cut off in a header")
                return
        head = bytes(buffer[at:end])
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
        size = int(fields[b"content-length"])
        begin = end + 4
        while len(buffer) < begin + size + 4:
            shift = at
            if not more():
                raise ValueError("archive is cut off in a block")
            begin -= shift
        yield fields, bytes(buffer[begin : begin + size])
        at = begin + size + 4


def _payload(block: bytes, declared: str) -> tuple[str, bytes]:
    """(status, payload) of a whole HTTP response block."""
    head, mark, body = block.partition(END)
    if not mark:
        return "bad_framing", b""
    try:
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError:
        return "bad_framing", b""
    fits = declared == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return ("ok" if fits else "digest_mismatch"), payload


_PARSED = "type string, record string, origin string, row long, page string, url string, digest string, refers string, segment int, total long, block binary, status string, size long, sha1 string, payload binary"


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(page, url, record_type, record, refers, payload_bytes, payload_digest, status[, payload]) of every page record.

    ``page`` is the page id as text.  ``status`` is ok, bad_framing, digest_mismatch,
    missing_segment or length_mismatch; a broken record keeps its row.
    """
    ship(spark)
    s = Scratch(spark, "warc")
    names = [f.split()[0] for f in _PARSED.split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [arrow[f.split()[1]] for f in _PARSED.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows: list[tuple] = []
                held = 0
                for f, block in parse(content.as_py()):
                    text = {k: v.decode() for k, v in f.items()}
                    kind, segment = text[b"warc-type"], int(text.get(b"warc-segment-number", 0))
                    me = text[b"warc-record-id"]
                    status = sha = payload = size = None
                    keep = None
                    if segment:
                        keep = block
                    elif kind == "response":
                        status, payload = _payload(block, text[b"warc-payload-digest"])
                        size, sha = len(payload), hashlib.sha1(payload).hexdigest()
                        payload = payload if with_payload else None
                    total = text.get(b"warc-segment-total-length")
                    rows.append((kind, me, text.get(b"warc-segment-origin-id", me), int(text[b"x-row"]), text.get(b"x-page"), text.get(b"warc-target-uri"), text.get(b"warc-payload-digest"), text.get(b"warc-refers-to"), segment, total and int(total), keep, status, size, sha, payload))
                    held += len(block) if keep or payload else 0
                    if len(rows) >= 4096 or held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(scan, _PARSED)
    # segments carry their bytes here, whole records only their measures; a group is one record
    heads = [F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c) for c in ("type", "record", "page", "url", "digest", "refers", "status", "size", "sha1", "payload")]
    parts = F.sort_array(F.collect_list(F.when(F.col("segment") > 0, F.struct("segment", "total", "block")))).alias("parts")
    grouped = found.groupBy("origin", "row").agg(*heads, parts)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in (r for k in range(0, b.num_rows, 64) for r in b.slice(k, 64).to_pylist()):
                parts = r["parts"]
                if parts:
                    block = b"".join(p["block"] for p in parts)
                    payload = b""
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] is None or r["type"] is None:
                        status = "missing_segment"
                    elif parts[-1]["total"] != len(block):
                        status = "length_mismatch"
                    else:
                        status, payload = _payload(block, r["digest"])
                    r |= {"status": status, "size": len(payload), "sha1": hashlib.sha1(payload).hexdigest(), "payload": payload if with_payload else None}
                out.append((r["type"] or "continuation", r["record"] or r["origin"], r["page"], r["url"], r["refers"], r["status"], r["size"], r["sha1"], r["payload"]))
            if out:
                kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["type", "record", "page", "url", "refers", "status", "size", "sha1", "payload"])

    whole = s.table(grouped.mapInArrow(join, "type string, record string, page string, url string, refers string, status string, size long, sha1 string, payload binary"))
    # written, so that the join can split a response that very many pages revisit
    target = whole.filter("type = 'response'").dropDuplicates(["record"]).select(F.col("record").alias("refers"), F.col("page").alias("to_page"), F.col("size").alias("to_size"), F.col("sha1").alias("to_sha1"), F.col("status").alias("to_status"), F.col("payload").alias("to_payload"))
    target = s.table(target)
    out = whole.join(target, "refers", "left")
    cols = [
        "page", "url", F.col("type").alias("record_type"), "record", F.col("to_page").alias("refers"),
        F.coalesce("size", "to_size").alias("payload_bytes"), F.coalesce("sha1", "to_sha1").alias("payload_digest"),
        F.coalesce("status", "to_status", F.lit("missing_target")).alias("status"),
    ]
    return out.select(*cols, *([F.coalesce("payload", "to_payload").alias("payload")] if with_payload else []))


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write ``pages``, read them back: (id_col, payload_bytes, payload_digest, record_type, refers_to, status)."""
    s = Scratch(pages.sparkSession, "archives")
    path = f"{s.root}/warc"
    write_archives(pages, path, id_col=id_col, **options)
    kind = pages.schema[id_col].dataType.simpleString()
    return read_archives(pages.sparkSession, path).select(F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast(kind).alias("refers_to"), "status")
