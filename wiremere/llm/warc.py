"""WARC archives, index first: write records and their index, then read byte ranges back.

Each write task makes one archive of gzip members, one per record, and gives out an index row per
record: file, offset, length, URL and digest. Reading starts from the index alone: selected rows are
dealt by file and offset range, sorted, and neighbours are read in one request each; members are then
inflated and parsed one by one. Archives lie in the shared folder and are written and read through
Arrow's file systems, so a retried task leaves an orphan file at most: only rows of the attempt that
succeeded are in the index.

Of pages with equal payloads of at least MIN_REVISIT bytes, those with the smallest page_id are
written as response, the others as revisit without payload, which names the response and its length.

Nulls: a null html is an empty payload, a null url gives no target header, a page without page_id is a
response of its own and is never referred to. Repeated rows give a record each.
"""

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiremere.llm.tables import prepare, stored
from wiremere.session import scratch

MIN_REVISIT = 100
GAP = 1 << 16  # bytes that are cheaper to read over than to request anew
RANGE = 16 << 20  # bytes of an archive that one task's group of reads covers
READ = 2 << 20  # largest single request
LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, url string, file string, offset long, length long, digest string"


def decide(pages: DataFrame) -> DataFrame:
    """pages with payload, payload_digest and refers_to (null for responses).

    The smallest id per digest is aggregated in the map tasks; only digests that occur more than
    once are joined back, with one row per digest, so a page of very many copies can be split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    named = named.withColumn("payload_digest", F.sha2("payload", 256))
    large = named.filter((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull())
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    first = stored(first.filter("first < last").select("payload_digest", "first"))
    refers = F.when((F.octet_length("payload") >= MIN_REVISIT) & (F.col("page_id") != F.col("first")), F.col("first"))
    return named.join(first, "payload_digest", "left").withColumn("refers_to", refers).drop("first")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Date: {date}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""

    def headers(lines: bytes) -> dict[str, str]:
        pairs = [line.split(": ", 1) for line in lines.decode().split("\r\n")[1:]]
        return {k.lower(): v for k, v in pairs}

    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, headers(http), payload


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, so that Arrow and Spark mean the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", whole)


def write(pages: DataFrame, folder: str | None = None, date: str | None = None) -> DataFrame:
    """Write archives of pages (page_id, url, html) to a shared folder; the stored index."""
    spark = pages.sparkSession
    prepare(spark)
    folder = qualified(spark, folder or scratch(spark, "warc"))
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, offset = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    files, path = pafs.FileSystem.from_uri(name)
                    files.create_dir(path.rsplit("/", 1)[0])
                    out = files.open_output_stream(path, compression=None)
                member = gzip.compress(record(page_id, url, payload.encode(), digest, refers_to, date), LEVEL, mtime=0)
                out.write(member)
                rows.append((page_id, url, name, offset, len(member), digest))
                offset += len(member)
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_INDEX.names, r)) for r in rows], _INDEX)
        if out is not None:
            out.close()

    columns = ["page_id", "url", "payload", "payload_digest", "refers_to"]
    return stored(decide(pages).select(columns).mapInArrow(run, INDEX))


_INDEX = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("digest", pa.string()),
    ]
)
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload string, payload_bytes long, "
    "payload_digest string, intact boolean"
)
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("intact", pa.bool_()),
    ]
)


def coalesce(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) members as requests (start, end, members)."""
    start = end = 0
    members: list[tuple[int, int]] = []
    for offset, length in rows:
        if members and (offset > end + GAP or offset + length - start > READ):
            yield start, end, members
            members = []
        if not members:
            start = offset
        members.append((offset, length))
        end = offset + length
    if members:
        yield start, end, members


def _row(member: bytes) -> dict:
    warc, http, payload = parse(gzip.decompress(member))
    of = lambda key: (warc[key][len("<urn:page:") : -1] or None) if key in warc else None
    page_id, refers_to = of("warc-record-id"), of("warc-refers-to")
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    response = warc["warc-type"] == "response"
    return {
        "page_id": page_id and int(page_id),
        "url": warc.get("warc-target-uri"),
        "record_type": warc["warc-type"],
        "refers_to": refers_to and int(refers_to),
        "payload": payload.decode() if response else None,
        "payload_bytes": len(payload) if response else int(http["content-length"]),
        "payload_digest": hashlib.sha256(payload).hexdigest() if response else digest,
        "intact": hashlib.sha256(payload).hexdigest() == digest if response else True,
    }


def read(index: DataFrame) -> DataFrame:
    """Records of the selected index rows; `intact` tells whether the payload has its digest."""
    prepare(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, now, handle = None, None, None
        for batch in batches:
            names = batch.column(0).to_pylist()
            spans = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            at = 0
            while at < len(names):
                upto = at
                while upto < len(names) and names[upto] == names[at]:
                    upto += 1
                if now != names[at]:
                    now = names[at]
                    files, path = pafs.FileSystem.from_uri(now)
                    handle = files.open_input_file(path)
                for start, end, members in coalesce(spans[at:upto]):
                    data = handle.read_at(end - start, start)
                    rows = [_row(data[o - start : o - start + n]) for o, n in members]
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                at = upto

    span = F.floor(F.col("offset") / F.lit(RANGE))
    # A given number of partitions: by their size, index rows would all be merged into a few tasks.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("file", "offset", "length", span.alias("span")).repartition(parts, "file", "span")
    return dealt.sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(run, RECORDS)


# DuckDB check of the records' types and digests.
SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
), r AS (
  SELECT *, payload_bytes >= {MIN_REVISIT} AND page_id <> first AS again FROM f
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM r
"""
