"""WARC archives: a deterministic sharded writer and its reader.

Rows are range-sorted by page_id and written by one task a range: each record
is a gzip member of its own, a file is rolled when its compressed size reaches
a limit, headers, record ids and digests are made anew from the row alone.  A
record whose payload an earlier page_id already has is a revisit.  Which row
comes first is found on (page_id, digest, size) alone; those verdicts travel
to the writer through the same range partitioning, just before their row, so
a payload is shuffled once.

Files are written under temporary names and moved when complete; a task that
runs again makes the same bytes under the same names.  ``manifest.json``,
written last, commits the archive.

Defined results
  * null html: an empty payload, equal to other empty ones;
  * repeated page_ids: each row gets a record; of rows equal in page_id and
    payload the first is the response and the others revisit it;
  * null page_id: counts as later than any number, and is read back as null;
  * null url: an empty target;
  * an empty table makes a manifest without files and reads back no rows;
  * other columns are not used.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import met, partitions, scratch, table, written
from .token_files import opened, place
from .tokens import slices

ROLL_BYTES = 256 << 20
LEVEL = 6
#: Records of the archive have one date, so that equal input makes equal bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "name string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
NAMES = uuid.UUID("6f0b8f5e-3d55-5c1d-9a53-0d6a7f8d2f11")


def record_id(page_id: int | None, digest: str, nth: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}:{digest}:{nth}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, nth: int) -> bytes:
    """One WARC/1.1 record: an HTTP response, or a revisit with its head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest, nth),
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-ID": "" if refers_to is None else str(refers_to)}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    """A gzip member without time stamp or name."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _Roller:
    """Files of one range, rolled by compressed size."""

    def __init__(self, folder: str, number: int, limit: int):
        self.folder, self.number, self.limit = folder, number, limit
        self.fs, self.path = opened(folder)
        self.done: list[tuple[str, int, int]] = []
        self.out = None

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.limit:
            self.close()
        if self.out is None:
            self.name, self.size, self.rows = f"part-{self.number:06d}-{len(self.done):04d}.warc.gz", 0, 0
            self.temporary = f"{self.path}/_temporary/{self.name}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None, buffer_size=1 << 20)
        self.out.write(member)
        self.size += len(member)
        self.rows += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            place(self.fs, self.temporary, f"{self.path}/{self.name}")
            self.done.append((self.name, self.rows, self.size))
            self.out = None


def _verdicts(rows: DataFrame, least: int) -> DataFrame:
    """(page_id, sha, refers_to) of rows whose payload a lesser page_id has."""
    narrow = written(rows.select("page_id", "sha", F.octet_length("html").alias("n")), "warc-digests")
    first = narrow.filter(F.col("n") >= least).groupBy("sha", "n").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("rows")).filter("rows > 1")
    # A payload that very many pages have, such as the empty one, is a hot key.
    later = met(narrow, written(first, "warc-first"), ["sha", "n"], "rows").filter("refers_to is not null and (page_id is null or page_id > refers_to)")
    return written(later.select("page_id", "sha", "refers_to").distinct(), "warc-verdicts")


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, least_revisit: int = 0, shards: int | None = None) -> dict:
    """Writes ``pages`` (page_id, url, html) to ``folder`` and returns the manifest."""
    fs, path = opened(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    verdicts = _verdicts(rows, least_revisit)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _Roller(folder, TaskContext.get().partitionId(), roll_bytes)
        here, refers, seen = object(), {}, {}
        for batch in batches:
            for some in slices(batch, "html"):
                for row in some.to_pylist():
                    page, sha = row["page_id"], row["sha"]
                    if page != here:
                        here, refers, seen = page, {}, {}
                    if row["html"] is None:
                        refers[sha] = row["refers_to"]
                        continue
                    payload = row["html"].encode()
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    nth = seen.get(sha, 0)
                    seen[sha] = nth + 1
                    again = sha in refers or nth > 0 and len(payload) >= least_revisit
                    target = refers.get(sha, page) if again else None
                    roller.add(_gzip(record(page, row["url"], payload, digest, target, again, nth)))
        roller.close()
        if roller.done:
            names, counts, sizes = zip(*roller.done, strict=True)
            yield pa.RecordBatch.from_pydict({"name": list(names), "n_records": list(counts), "n_bytes": list(sizes)})

    marks = verdicts.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha", "refers_to")
    both = rows.withColumn("refers_to", F.lit(None).cast("long")).unionByName(marks)
    order = [F.col("page_id").asc_nulls_last(), F.col("html").isNotNull(), F.col("sha"), F.col("url")]
    ranged = both.repartitionByRange(shards or partitions(pages.sparkSession), order[0]).sortWithinPartitions(*order)
    files = [{"name": n, "n_records": r, "n_bytes": b} for n, r, b in sorted(ranged.mapInArrow(emit, FILES).collect())]
    manifest = {"files": files}
    temporary = f"{path}/_temporary/manifest-{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps(manifest).encode())
    place(fs, temporary, f"{path}/manifest.json")
    fs.delete_dir(f"{path}/_temporary")
    return manifest


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each gzip member, one at a time."""
    pending = b""
    while True:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            data = pending or stream.read(1 << 20)
            pending = b""
            if not data:
                if parts:
                    raise ValueError("the archive is cut off")
                return
            parts.append(member.decompress(data))
        pending = member.unused_data
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        yield fields, rest[: int(fields["Content-Length"])]


def _parsed(fields: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda name: int(fields[name]) if fields.get(name) else None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"{fields['WARC-Record-ID']}: the block digest differs")
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload digest differs")
    return {
        "page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": kind, "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest, "refers_to": number("X-Refers-To-Page-ID"), "payload": payload if kind == "response" else None,
    }


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a committed archive, digests verified; a revisit has no payload of its own."""
    fs, path = opened(folder)
    files = json.loads(fs.open_input_stream(f"{path}/manifest.json").read())["files"]
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for name, expected in zip(batch["name"].to_pylist(), batch["n_records"].to_pylist(), strict=True):
                held, size, n = [], 0, 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for fields, block in _records(stream):
                        held.append(_parsed(fields, block))
                        size, n = size + len(block), n + 1
                        if size > 4 << 20 or len(held) >= 2000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)
                if n != expected:
                    raise ValueError(f"{name} holds {n} records, the manifest says {expected}")

    listed = spark.createDataFrame([(f["name"], f["n_records"]) for f in files], "name string, n_records long")
    return listed.repartition(max(1, len(files)), "name").mapInArrow(rows, RECORDS)


def query(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    write(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    """Digests are in hexadecimal in SQL; 20 bytes are 160 bits, or 32 letters of base32."""
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      ((('0x' || substr(x, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '') AS payload_digest
  FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""
