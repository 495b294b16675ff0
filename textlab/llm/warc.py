"""WARC archives: write captures, read records back, assemble one nested row per capture."""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from textlab.llm.staging import shared_folder, staged

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 3000
CRLF = "\r\n"
ARROW = {
    "type": pa.string(), "record_id": pa.string(), "concurrent_to": pa.string(), "refers_to": pa.string(),
    "uri": pa.string(), "date": pa.string(), "block_bytes": pa.int64(), "payload_bytes": pa.int64(),
    "payload_digest": pa.string(), "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary(),
}
RECORD = from_arrow_schema(pa.schema(list(ARROW.items())))


def _one_line(text: Column) -> Column:
    for character, code in (("\\r", "%0D"), ("\\n", "%0A"), (" ", "%20")):
        text = F.regexp_replace(text, character, code)
    return text


def _header(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in pairs])


def _record(kind: Column, record_id: Column, pairs: list[tuple[str, Column]], content: str, block: Column) -> Column:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), *pairs, ("Content-Type", F.lit(content)),
            ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit("WARC/1.0" + CRLF), _header(head), F.lit(CRLF), block)


def _urn(kind: str) -> Column:
    return F.concat(F.lit(f"<urn:textlab:{kind}:"), F.col("capture"), F.lit(">"))


def write_captures(pages: DataFrame, path: str) -> None:
    """Request, response or revisit, and metadata records of every page, as gzip files below ``path``.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are not read. Of the pages with equal payloads
    of at least 1000 bytes the largest ``page_id`` is written whole and the others as revisits; repeated
    rows of that id are each whole. Null html is an empty payload; a null url has no target line, and control
    characters in one are percent-encoded. A null ``page_id`` has no page line and is never referred to.
    Spark's text writer ends each row with the two line ends that close a record.
    """
    rows = pages.select(
        F.col("page_id").alias("page"), _one_line(F.col("url").cast("string")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("size", F.octet_length("html")).withColumn("content", F.sha2("html", 256))
    same = staged(
        rows.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("content").agg(F.max("page").alias("whole"), F.count("*").alias("n"))
        .where("n > 1 and whole is not null").select("content", "whole"), "payloads",
    )
    marked = rows.join(same, "content", "left").withColumn(
        "whole", F.when(~F.col("page").eqNullSafe(F.col("whole")), F.col("whole"))
    ).withColumn("capture", F.expr("uuid()"))
    digest = F.concat(F.lit("sha1:"), F.sha1("html"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF))
    shared = [("WARC-Date", F.lit("2024-01-01T00:00:00Z")), ("WARC-Target-URI", F.col("url"))]
    refers = F.concat(F.lit("<urn:textlab:page:"), F.col("whole").cast("string"), F.lit(">"))
    is_revisit = F.col("whole").isNotNull()
    main = _record(
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")), _urn("response"),
        [*shared, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.when(is_revisit, refers)),
         ("WARC-Profile", F.when(is_revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))],
        "application/http; msgtype=response", F.when(is_revisit, http).otherwise(F.concat(http, "html")),
    )
    request = _record(F.lit("request"), _urn("request"), [*shared, ("WARC-Concurrent-To", _urn("response"))],
                      "application/http; msgtype=request", F.lit(f"GET / HTTP/1.1{CRLF}Accept: */*{CRLF}{CRLF}"))
    metadata = _record(F.lit("metadata"), _urn("metadata"), [*shared, ("WARC-Concurrent-To", _urn("response"))],
                       "application/warc-fields", _header([("page", F.col("page").cast("string")), ("payload-bytes", F.col("size").cast("string"))]))
    records = marked.select(F.explode(F.array(request, main, metadata)).alias("value"))
    records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _fields(block: bytes) -> list[tuple[str, str]]:
    out = []
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out.append((name.strip(), value.strip()))
    return out


def parse(stream: io.BufferedIOBase):
    """The records of one archive, by their stated lengths: (headers with lower-case names, block)."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("an archive ends inside a record")
        yield headers, block


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path`` (plain or gzip); HTTP payloads only on demand."""
    names = [f.name for f in RECORD.fields if payload or f.name != "payload"]
    schema = T.StructType([RECORD[n] for n in names])
    target = pa.schema([(n, ARROW[n]) for n in names])

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                content = content.as_py()
                stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
                rows, held = [], 0
                for headers, block in parse(io.BufferedReader(stream)):
                    kind = headers.get("warc-type", "")
                    http = headers.get("content-type", "").startswith("application/http")
                    cut = block.find(b"\r\n\r\n") + 4 if http and b"\r\n\r\n" in block else 0
                    body = block[cut:] if http else b""
                    whole = kind != "revisit"
                    row = {
                        "type": kind, "record_id": headers.get("warc-record-id"),
                        "concurrent_to": headers.get("warc-concurrent-to"), "refers_to": headers.get("warc-refers-to"),
                        "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "block_bytes": len(block),
                        "payload_bytes": len(body) if whole else None,
                        "payload_digest": hashlib.sha1(body).hexdigest() if whole else headers.get("warc-payload-digest", "").partition(":")[2],
                        "fields": _fields(block[:cut] if http else block),
                    }
                    if payload:
                        row["payload"] = body if whole else None
                    rows.append(row)
                    held += len(block)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=target)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, schema)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture``, ``request``, ``response`` (or revisit), ``metadata``.

    Request and metadata records name the response they belong to (``concurrent_to``); a capture's key is
    that name or, for the response itself, its own id, so one grouping joins all three. Members that are
    missing are null; of several requests or metadata records of a capture the smallest id is taken.
    """
    record = F.struct(*[F.col(c) for c in records.columns])

    def part(*kinds):
        own = F.col("type").isin(*kinds)
        return F.min_by(F.when(own, record), F.when(own, F.col("record_id")))

    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        part("request").alias("request"), part("response", "revisit").alias("response"), part("metadata").alias("metadata"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives into the shared folder, read them back, and describe every page's capture.

    Columns: ``page_id``, ``uri``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. A revisit has no
    payload of its own: its digest comes from its header and its length from its metadata record.
    An empty table gives an empty result.
    """
    path = shared_folder(pages.sparkSession, "warc")
    write_captures(pages, path)
    found = transactions(read_records(pages.sparkSession, path, payload=False))
    return found.select(
        F.col("metadata.fields")["page"].cast("bigint").alias("page_id"), F.col("response.uri").alias("uri"),
        F.coalesce("response.payload_bytes", F.col("metadata.fields")["payload-bytes"].cast("bigint")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.regexp_extract("response.refers_to", "page:(-?[0-9]+)", 1).cast("bigint").alias("refers_to"),
    )
