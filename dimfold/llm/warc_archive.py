"""WARC archives that are read through their index.

Writing: every record is a gzip member of its own in an archive file, and its
index row (path, offset, length, URL, digest) goes to an index table. Reading
starts at the index: the selected rows are sorted by path and offset,
neighbouring byte ranges are coalesced, each range is read once and cut into
records.

Of records with equal payloads that with the largest page_id is a response,
the others are revisits that refer to it and carry its HTTP head alone.

Scale: which record is the response is found on (page_id, digest) rows, with the
largest id combined before the shuffle; AQE splits the join where a third of all
pages share a payload. The html is shuffled once, by an even key. A task writes
one archive, or several of ``file_bytes``; a repeated task writes new files, and
only the files that the committed index names count. A reader holds one range
of at most ``range_bytes``, or one record. ``folder`` must be a folder that all
executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import dealt_anew, durable, pick, read
from dimfold.session import ensure_checkpoint_dir

FILE_BYTES = 1 << 30
RANGE_BYTES, GAP_BYTES, TASK_BYTES = 8 << 20, 64 << 10, 128 << 20
INDEX = "path string, offset long, length long, url string, payload_digest string, page_id long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decide(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) as (page_id, url, payload, sha, best): best is the page_id of the payload's response.

    Null html is an empty payload. A null page_id is smaller than any, and
    ``best`` is null if a payload has no other.
    """
    marked = pick(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    key = F.concat("sha", F.lit(":"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    narrow = durable(marked.select("page_id", "sha").distinct())
    best = dealt_anew(narrow.groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("n")), "n", "sha")
    chosen = narrow.join(best, "sha").select(key.alias("key"), "best")
    return marked.withColumn("key", key).join(chosen.hint("merge"), "key").drop("key")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, best: int | None) -> bytes:
    """One WARC record."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    name = lambda n: f"<urn:page:{'' if n is None else n}>"
    response = best is None or page_id == best
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if response:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(best)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """The fields of RECORD. Raises ValueError where lengths or digest don't hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda key: int(n) if (n := fields.get(key, "")[len("<urn:page:"):-1]) else None
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return (number("WARC-Record-ID"), fields["WARC-Target-URI"], fields["WARC-Type"], number("WARC-Refers-To"), size, digest,
            payload if fields["WARC-Type"] == "response" else None)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], columns: str) -> pa.RecordBatch:
    """Rows as a batch of ``columns`` ("name type, ..."), nulls and long numbers as they are."""
    names, types = zip(*(x.split() for x in columns.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*rows), types)], list(names))


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, path = None, 0, None
        try:
            for batch in batches:
                rows = []
                for page, url, payload, sha, best in zip(*(c.to_pylist() for c in batch.columns)):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    member = gzip.compress(record_bytes(page, url, payload.encode("utf-8", "replace"), digest, best), 4, mtime=0)
                    if out is None or at and at + len(member) > file_bytes:
                        if out is not None:
                            out.close()
                        store, base = pyarrow.fs.FileSystem.from_uri(folder)
                        path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)
                    out.write(member)
                    rows.append((path, at, len(member), url, digest, page))
                    at += len(member)
                if rows:
                    yield _batch(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives of ``pages`` and their index below ``folder``; returns the index table.

    The index has path, offset, length (of the gzip member), url,
    payload_digest and page_id. An empty table gives an empty index.
    """
    indexed = decide(pages).select("page_id", "url", "payload", "sha", "best").mapInArrow(_writer(f"{folder}/archives", file_bytes), INDEX)
    indexed.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _reader(range_bytes: int, gap_bytes: int, with_payload: bool):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Runs of rows of one file that lie near each other."""
        path, run = None, []
        for batch in batches:
            for p, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if run and (p != path or offset - sum(run[-1]) > gap_bytes or offset + length - run[0][0] > range_bytes):
                    yield path, run
                    run = []
                path = p
                run.append((offset, length))
        if run:
            yield path, run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, name = None, None
        for path, members in ranges(batches):
            if path != name:
                if source is not None:
                    source.close()
                store, base = pyarrow.fs.FileSystem.from_uri(path)
                source, name = store.open_input_file(base), path
            first, last = members[0][0], max(sum(m) for m in members)
            data = source.read_at(last - first, first)
            rows = [parse_record(gzip.decompress(data[at - first:at - first + size])) for at, size in members]
            yield _batch(rows, RECORD) if with_payload else _batch([r[:-1] for r in rows], RECORD.rpartition(", ")[0])
        if source is not None:
            source.close()

    return run


def read_records(index: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES, with_payload: bool = True,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of the selected ``index`` rows, a row each, read from their archives.

    Columns as in RECORD: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and, unless left out, payload (null for a revisit). Rows of
    the index may repeat. Payload lengths and digests are verified.

    Tasks are counted by the archives' bytes, not the index's, which are few: one for each
    ``task_bytes`` at least, and as many as the session shuffles to while each has a range to read.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-size // task_bytes), min(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes)))
    schema = RECORD if with_payload else RECORD.rpartition(", ")[0]
    return index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(
        _reader(range_bytes, gap_bytes, with_payload), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """A WARC round trip of ``pages``.

    Null and empty html are empty payloads; null ids and URLs are empty fields;
    repeated rows of a payload's largest page_id are responses each.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_records(write_archives(read(spark, sf_dir, "pages"), folder), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB form of the op10 query.
ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, html, list_reduce(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(sha1(html), CAST(i AS INTEGER), 1) AS INTEGER)), 4, '0')), lambda a, b: a || b) AS bits,
    max(page_id) OVER (PARTITION BY html) AS best
  FROM p
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST('0b' || substr(bits, CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM d
"""
