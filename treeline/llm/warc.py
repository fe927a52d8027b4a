"""WARC archives with an index that is written first and read first.

Writing gives, with the archives, one index row per record: file, offset, length, URL, digest, type. A
reader selects rows of the index, sorts them by place, joins neighbouring ranges into one read each, and
never opens the rest of a file. Records are gzip members of their own.

A record whose payload a record with a smaller id has, is written as a revisit: it refers to the first
one and holds no payload, its HTTP header keeps the payload's length.

Edge cases: a null payload is an empty one; a null URL is written as ``urn:page:<id>``, a null id as
``null``. Rows that repeat an id are all written; of equal payloads, every row with the smallest id is a
response. An empty table gives no archives and an empty index. Very long payloads are written whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_store import new_folder, open_file, put_file, written

GAP, SPAN = 64 << 10, 8 << 20  #: ranges at most GAP apart are read together, up to SPAN bytes
READ = 32 << 20  #: bytes of archives that a task reads
INDEX = "record_id long, file string, offset long, length long, url string, digest string, record_type string"
STAMP = "2000-01-01T00:00:00Z"  #: records are dated so, that a repeated task writes the same bytes


def _record(page_id, url: str, payload: bytes, digest: str, first: int | None, first_url: str | None) -> bytes:
    revisit = first_url is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {STAMP}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
        *((f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Refers-To-Target-URI: {first_url}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest") if revisit else ()),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """Headers of one record, and its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": fields, "payload": payload, "payload_bytes": size}


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Write archives; returns the index, a written table. Payloads of fewer than ``min_revisit_bytes`` bytes are never revisits."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    slim = pages.select(F.col(key).cast("long").alias("k"), F.regexp_replace(F.coalesce(F.col(url), F.concat(F.lit("urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))), r"\s", "%20").alias("u"), body.alias("b"))
    slim = slim.withColumn("d", F.sha1("b"))
    # One row per digest leaves each map task, so a payload that a third of all pages share is no hot key here.
    firsts = slim.groupBy("d").agg(F.min(F.struct(F.col("k").isNull().alias("n"), "k", "u")).alias("f"), F.count("*").alias("copies")).filter("copies > 1")
    # The join below may be skewed on its left side; each match is one row, so Spark's skew join splits it.
    marked = slim.join(firsts.select(F.col("d"), F.col("f.k").alias("fk"), F.col("f.u").alias("fu"), F.lit(True).alias("again")), "d", "left")
    # The rows stay where the join put them: a second shuffle of the payloads would only order the archives.
    ordered = marked.sortWithinPartitions(F.col("k").asc_nulls_first(), "u", "d")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, index = f"part-{TaskContext.get().partitionId():06d}.warc.gz", []

        def chunks() -> Iterator[bytes]:
            at = 0
            for batch in batches:
                for row in batch.to_pylist():
                    data, digest = row["b"], base64.b32encode(bytes.fromhex(row["d"])).decode()
                    lead = not row["again"] or len(data) < min_revisit_bytes or row["k"] == row["fk"]
                    record = gzip.compress(_record("null" if row["k"] is None else row["k"], row["u"], data, digest, None if lead else row["fk"], None if lead else row["fu"]), 6, mtime=0)
                    index.append((row["k"], f"{folder}/{name}", at, len(record), row["u"], digest, "response" if lead else "revisit"))
                    at += len(record)
                    yield record

        put_file(folder, name, chunks())
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = [x.split()[0] for x in INDEX.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in index], kinds[i]) for i in range(len(kinds))], names)

    return written(ordered.mapInArrow(run, INDEX), "warc-index")


def coalesced(ranges: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Join sorted (file, offset, length) into (file, begin, end, parts) with one read each."""
    name, begin, end, parts = None, 0, 0, []
    for file, at, n in ranges:
        if parts and (file != name or at - end > GAP or at + n - begin > SPAN):
            yield name, begin, end, parts
            parts = []
        if not parts:
            name, begin, end = file, at, at + n
        parts.append((at, n))
        end = max(end, at + n)
    if parts:
        yield name, begin, end, parts


def read_records(selected: DataFrame, payloads: bool = False) -> DataFrame:
    """Read the records that an index names. Returns record_id, file, offset, url, payload_bytes, payload_digest, record_type, refers_to, and payload if asked for."""
    places = selected.select("record_id", "file", "offset", "length")
    # The index is small whatever it points to, so tasks are counted by the bytes and records that they read, not by its own size.
    total = places.agg(F.sum("length").alias("bytes"), F.count("*").alias("records")).first()
    tasks = max(-(-(total["bytes"] or 0) // READ), min(-(-total["records"] // 100), selected.sparkSession.sparkContext.defaultParallelism), 1)
    places = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    schema = "record_id long, file string, offset long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    arrow = pa.schema([("record_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), *[("payload", pa.binary())] * payloads])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            rows = batch.to_pylist()
            ids = iter(r["record_id"] for r in rows)
            for name, begin, end, parts in coalesced((r["file"], r["offset"], r["length"]) for r in rows):
                if name != path:
                    path, file = name, open_file(name)
                file.seek(begin)
                data, out = file.read(end - begin), []
                for at, n in parts:
                    rec = parse(gzip.decompress(data[at - begin : at - begin + n]))
                    head = rec["headers"]
                    refers = head.get("WARC-Refers-To", "").removeprefix("<urn:page:").rstrip(">")
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                    place = {"record_id": next(ids), "file": name, "offset": at, "url": head["WARC-Target-URI"]}
                    body = {"payload_bytes": rec["payload_bytes"], "payload_digest": digest, "payload": rec["payload"]}
                    out.append(place | body | {"record_type": kind, "refers_to": int(refers) if refers not in ("", "None") else None})
                    if kind == "response" and base64.b32encode(hashlib.sha1(rec["payload"]).digest()).decode() != digest:
                        raise ValueError(f"{name} at {at}: the payload doesn't have its digest")
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return places.mapInArrow(run, schema)
