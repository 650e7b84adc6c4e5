"""WARC archives: records are written as gzip members of files of bounded size, read back block by block, and assembled
by transaction."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Staged, bound_batches, delete_path, narrow, new_path

CRLF = "\r\n"
#: Fixed values of the format.
VERSION, SOFTWARE_DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to string, target_uri string, refers_to string, page_id bigint, "
    "payload_bytes bigint, payload_digest string, payload binary, file string"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: five bits at a time from four 40-bit parts of the hexadecimal digest."""
    h = F.sha1(payload)
    parts = [F.conv(F.substring(h, 1 + 10 * g, 10), 16, 10).cast("long") for g in range(4)]
    at = [F.shiftright(p, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1 for p in parts for j in range(8)]
    return F.concat(*[F.substring(F.lit(BASE32), i, F.lit(1)) for i in at])


def _urn(kind: str, page: str, url: str, copy: str) -> Column:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    m = F.md5(F.concat_ws("/", F.lit(kind), text(page), text(copy), text(url), F.col("payload_digest")))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in (([F.lit("-")] if i else []) + [F.substring(m, a, n)])], F.lit(">"))


def _record(headers: list[tuple[str, Column | str | None]], content_type: str, block: Column) -> Column:
    lines: list[Column] = [F.lit(VERSION + CRLF)]
    for k, v in headers:
        if v is not None:
            c = F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v), F.lit(CRLF))
            lines.append(F.coalesce(c, F.lit("")))
    lines += [F.lit(f"Content-Type: {content_type}{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2), block, F.lit(CRLF * 2)]
    return F.concat(*lines)


#: What tells a row from others: without nulls, so that a grouping by these columns and a join on them share a shuffle.
_ROW = ["payload_digest", "payload_bytes", "no_id", "some_id", "no_url", "some_url"]


def plan_captures(pages: DataFrame, st: Staged, min_payload: int) -> DataFrame:
    """A row per capture to write: ``page_id, url, payload_digest, payload_bytes, copy, html, revisit`` and for revisits, which
    have no html, ``first_page, first_url`` of the response.

    Who is the response is decided on rows without payloads, where rows repeated whole are one row with a count. Payloads
    are shuffled once, rows repeated whole one per task, and only to meet the rows that need them.
    """
    d = pages.withColumn("payload_digest", base32_sha1(F.col("html").cast("binary"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    d = d.withColumns({"no_id": F.col("page_id").isNull(), "some_id": F.coalesce("page_id", F.lit(0)), "no_url": F.col("url").isNull(), "some_url": F.coalesce("url", F.lit(""))})
    keys = st.write(d.groupBy(*_ROW).agg(F.count(F.lit(1)).alias("copies")), "warc-keys")
    heads = keys.where(F.col("payload_bytes") >= min_payload).groupBy("payload_digest", "payload_bytes").agg(F.min(F.struct(*_ROW[2:])).alias("first"))
    heads = st.write(heads, "warc-heads")
    mine = F.col("first") == F.struct(*_ROW[2:])
    roles = keys.join(heads, ["payload_digest", "payload_bytes"], "left").withColumn("head", F.coalesce(mine, F.lit(True)))
    roles = st.write(roles, "warc-roles")
    # revisits: every copy of other rows, and all copies but the first of a head
    again = roles.where(F.col("first").isNotNull()).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).where("not head or copy > 0")
    names = [*_ROW, "copy", "html", "first"]
    again = again.withColumn("html", F.lit(None).cast("string")).select(*names)
    # responses: the heads, and every copy of what is too short to be revisited
    need = roles.where("head").select(*_ROW, F.when(F.col("first").isNull(), F.col("copies")).otherwise(F.lit(1)).alias("write"))
    whole = d.groupBy(*_ROW).agg(F.first("html").alias("html")).join(need, _ROW)
    whole = whole.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("write") - 1))).withColumn("first", F.lit(None).cast(roles.schema["first"].dataType))
    given = lambda at="": (F.when(~F.col(f"{at}no_id"), F.col(f"{at}some_id")), F.when(~F.col(f"{at}no_url"), F.col(f"{at}some_url")))
    page, url = given()
    first_page, first_url = given("first.")
    return whole.select(*names).unionByName(again).select(
        page.alias("page_id"), url.alias("url"), "payload_digest", "payload_bytes", "copy", "html", F.col("first").isNotNull().alias("revisit"), first_page.alias("first_page"), first_url.alias("first_url")
    )


def write_archives(pages: DataFrame, path: str, min_payload: int = 0, file_bytes: int = 256 << 20, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a request, a response or revisit, and a metadata record for each row of ``pages``; returns the index of what was
    written: ``file, offset, length`` of blocks of whole gzip members, a member per record.

    Of rows with equal payloads of ``min_payload`` bytes or more the smallest page_id (null last; then the smallest URL) is
    a response and the others, its repetitions too, are revisits of it. Null html is an empty payload; a null URL is left
    out of the records. The identifier is an integer. A file ends at the first record that takes it past ``file_bytes``.
    The files of a task that is run again are written again under other names: what the index names counts.
    """
    spark = pages.sparkSession
    st = Staged(spark)
    bound_batches(spark)
    p = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    p = p.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = plan_captures(p, st, min_payload).withColumn("zero", F.lit(0).cast("long"))
    rid, urn = _urn("response", "page_id", "url", "copy"), lambda kind: _urn(kind, "page_id", "url", "copy")
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    base = lambda kind, i: [("WARC-Type", kind), ("WARC-Record-ID", i), ("WARC-Date", SOFTWARE_DATE), ("WARC-Target-URI", F.col("url"))]
    host = F.coalesce(F.regexp_extract("url", "^[^:]*://([^/?#]*)", 1), F.lit(""))
    target = F.coalesce(F.nullif(F.regexp_extract("url", "^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    get = F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2))
    request = _record([*base("request", urn("request")), ("WARC-Concurrent-To", rid)], "application/http; msgtype=request", get)
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    more = [
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(F.col("revisit"), _urn("response", "first_page", "first_url", "zero"))),
        ("WARC-Payload-Digest", digest),
    ]
    response = _record([*base(kind, rid), *more], "application/http; msgtype=response", F.concat(http, F.coalesce("html", F.lit(""))))
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    metadata = _record([*base("metadata", urn("metadata")), ("WARC-Concurrent-To", rid)], "application/warc-fields", fields)
    index = st.write(rows.select(request.alias("a"), response.alias("b"), metadata.alias("c")).mapInArrow(_writer(path, file_bytes), INDEX_SCHEMA), "warc-index")
    return index


INDEX_SCHEMA = "file string, offset bigint, length bigint"


def _file_system(path: str):
    """The file system and the path on it, for workers: local, HDFS or an object store."""
    from pyarrow import fs

    uri = re.sub("^file:/+", "file:///", re.sub("^s3[an]:", "s3:", path))
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), path)


def _writer(folder: str, file_bytes: int, block_bytes: int = 4 << 20):
    def run(batches):
        import uuid

        system, at = _file_system(folder)
        out, name, size, block, index = None, "", 0, 0, []
        for batch in batches:
            columns = [c.cast(pa.large_binary()) for c in batch.columns]
            for record in (c[i].as_buffer() for i in range(batch.num_rows) for c in columns):
                if out is None:
                    system.create_dir(at, recursive=True)
                    name, size, block = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{at}/{name}", compression=None)
                squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = squeeze.compress(record) + squeeze.flush()
                out.write(member)
                size += len(member)
                if size - block >= block_bytes or size >= file_bytes:
                    index.append((f"{folder}/{name}", block, size - block))
                    block = size
                if size >= file_bytes:
                    out.close()
                    out = None
            if index:
                yield _index(index)
                index = []
        if out is not None:
            out.close()
            if size > block:
                yield _index([(f"{folder}/{name}", block, size - block)])

    return run


def _index(rows) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["file", "offset", "length"])


def iter_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by its Content-Length, whatever the block contains."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        for line in iter(stream.readline, b""):
            if line in (b"\r\n", b"\n"):
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("a record ends early")
        yield headers, block


def _http(block: bytes) -> tuple[dict[bytes, bytes], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}, body


def _parse(batches, batch_bytes: int = 8 << 20):
    """Records of blocks ``file, offset, length``; a block without a length is its whole file. Blocks are read as streams."""
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string()),
    ])
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for name, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            system, at = _file_system(name)
            with system.open_input_file(at) as whole:
                whole.seek(offset or 0)
                raw = whole if length is None else io.BytesIO(whole.read(length))
                packed = raw.read(2) == b"\x1f\x8b"
                raw.seek((offset or 0) if length is None else 0)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 20)
                for h, block in iter_records(stream):
                    rows.append((*_fields(h, block), name))
                    held += len(block) + 300
                    if held > batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _fields(h: dict[str, str], block: bytes) -> tuple:
    kind, page, size, digest, payload = h.get("warc-type"), None, None, None, None
    if kind in ("response", "revisit"):
        http, body = _http(block)
        if kind == "response":
            payload, size, digest = body, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
            if (said := h.get("warc-payload-digest", "")) not in ("", f"sha1:{digest}"):
                raise ValueError(f"payload of {h.get('warc-record-id')} does not match {said}")
        else:
            size, digest = int(http.get(b"content-length", b"0")), h.get("warc-payload-digest", "").removeprefix("sha1:")
    elif kind == "metadata":
        fields = dict(x.partition(":")[::2] for x in block.decode("utf-8", "replace").split(CRLF))
        page = int(v) if (v := fields.get("page-id", "").strip()) else None
    return h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-refers-to"), page, size, digest, payload


def read_records(index: DataFrame) -> DataFrame:
    """One row per WARC record of the blocks in ``index`` (``file, offset, length``), a task for each block, or for several
    where there are more than ten thousand."""
    tasks = max(1, min(10_000, index.count()))
    return index.select("file", "offset", "length").repartition(tasks, F.xxhash64("file", "offset")).mapInArrow(_parse, RECORD_SCHEMA)


def read_files(spark, path: str, glob: str = "*.warc*") -> DataFrame:
    """One row per WARC record of the files under ``path`` (gzip, one or many members, or plain); a file is read as a stream
    by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return read_records(files.select(F.col("path").alias("file"), F.lit(0).cast("long").alias("offset"), F.lit(None).cast("long").alias("length")))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, page_id, request, response, metadata, refers_to_page``.

    A capture is a response or revisit record; its request and metadata records name it as concurrent. A capture without
    them has nulls there; of several the smallest record identifier counts. Requests and metadata of unknown captures
    are left out. A revisit's ``refers_to_page`` is the page of the capture it refers to (null when that is missing).
    """
    part = lambda kind, *cols: records.where(F.col("record_type") == kind).groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(F.struct("record_id", *cols)).alias(kind))
    main = records.where(F.col("record_type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), F.struct("record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload").alias("response"))
    caps = main.join(part("request", "target_uri"), "capture_id", "left").join(part("metadata", "page_id"), "capture_id", "left")
    heads = records.where((F.col("record_type") == "metadata") & F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("refers_to"), F.col("page_id").alias("refers_to_page"))
    caps = caps.withColumn("refers_to", F.coalesce(F.col("response.refers_to"), F.concat(F.lit("none-"), F.col("capture_id"))))
    return caps.join(heads, "refers_to", "left").select("capture_id", F.col("metadata.page_id").alias("page_id"), "request", "response", "metadata", "refers_to_page")


def round_trip(pages: DataFrame, min_payload: int = 0, **cols: str) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder, read them back and assemble the captures. The archives go when
    they have been read; what was read stays for the result."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    st = Staged(spark)
    index = write_archives(pages, path, min_payload, **cols)
    records = st.write(read_records(index), "warc-records")
    st.drop(index)
    delete_path(spark, path)
    return assemble(records)
