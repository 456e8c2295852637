"""Token-ID files: flat unsigned ids plus 64-bit document offsets.

A folder holds, for each shard P-R (the R-th of partition P),
  ``shard-P-R.bin``   ids, little-endian unsigned, 16 bits while the vocabulary
                      fits, else 32;
  ``shard-P-R.off``   64-bit starts of the shard's documents and its end;
  ``shard-P-R.doc``   64-bit doc_ids (rows with a null doc_id come first, the
                      manifest says how many there are);
and ``manifest.json`` with the width, and each shard's rows, tokens and base.
Shards ascend by doc_id; a base is the prefix sum of the tokens of the shards
before it, so start = base + local offset everywhere.

Writing: documents are range-partitioned and sorted by doc_id; each task
encodes and appends to all three files, holding one group of texts, and rolls
them at ``ROLL`` bytes of ids; each finished shard goes from temporary to final
names.  A task that runs again makes the same bytes under the same final names.
The manifest, written last, commits the folder.

Reading: one task a shard, a run of documents at a time.  On a local or mounted
disk the files are memory-mapped; any other store is read by byte ranges.

Defined results
  * null text: empty, thus the end id alone;
  * repeated doc_ids: every row is written, ties ordered by text;
  * null doc_ids come first and are read back as null;
  * an empty table makes a manifest without shards and reads back no rows;
  * other columns are not used.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, scratch, table
from .packing import END_ID, id_code
from .tokens import encoder_for, slices

SHARD = "shard int, nth int, n_docs long, n_tokens long, n_null long"
READ = "doc_id long, start long, n_tokens long, ids binary"
BUFFER = 4 << 20
#: Bytes of ids at which a shard is closed and the next one begun.
ROLL = 512 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI or a plain path."""
    if "://" not in uri:  # Hadoop writes file:/path, with one slash
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def place(fs: pafs.FileSystem, temporary: str, final: str) -> None:
    """Moves a finished file to its name, over an equal one of an earlier attempt."""
    try:
        fs.move(temporary, final)
    except OSError:
        if fs.get_file_info(final).type != pafs.FileType.File:
            raise
        fs.delete_file(final)
        fs.move(temporary, final)


class _Shard:
    """Three files of one shard, written side by side."""

    KINDS = ("bin", "off", "doc")

    def __init__(self, fs: pafs.FileSystem, path: str, number: int, nth: int):
        self.fs, self.number, self.nth = fs, number, nth
        self.own, self.final = f"{path}/_temporary/{number:06d}-{nth:06d}-{uuid.uuid4().hex}", f"{path}/shard-{number:06d}-{nth:06d}"
        self.out = {k: fs.open_output_stream(f"{self.own}.{k}", buffer_size=BUFFER if k == "bin" else 1 << 16) for k in self.KINDS}
        self.docs = self.tokens = self.nulls = self.bytes = 0
        self.out["off"].write(bytes(8))

    def add(self, name: int, null: bool, ids: bytes, n: int) -> None:
        self.out["bin"].write(ids)
        self.docs, self.tokens, self.nulls, self.bytes = self.docs + 1, self.tokens + n, self.nulls + null, self.bytes + len(ids)
        self.out["off"].write(self.tokens.to_bytes(8, "little"))
        self.out["doc"].write(name.to_bytes(8, "little", signed=True))

    def finished(self) -> pa.RecordBatch:
        for k in self.KINDS:
            self.out[k].close()
        for k in self.KINDS:
            place(self.fs, f"{self.own}.{k}", f"{self.final}.{k}")
        return pa.RecordBatch.from_pydict({"shard": pa.array([self.number], pa.int32()), "nth": pa.array([self.nth], pa.int32()), "n_docs": [self.docs], "n_tokens": [self.tokens], "n_null": [self.nulls]})


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, spaced: bool = False, shards: int | None = None, roll: int = ROLL) -> dict:
    """Writes ``docs`` to ``folder`` and returns the manifest."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    code = id_code(tokenizer, end_id)
    fs, path = opened(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_for(tokenizer, spaced, code), np.array([end_id], code).tobytes()
        number, fs, path = TaskContext.get().partitionId(), *opened(folder)
        out, nth = None, 0
        for batch in batches:
            for rows in slices(batch, "text"):
                names, nulls = rows["doc_id"].fill_null(0).to_numpy(), rows["doc_id"].is_null().to_numpy(zero_copy_only=False)
                for name, null, ids in zip(names, nulls, encoder(rows["text"].to_pylist()), strict=True):
                    out = out or _Shard(fs, path, number, nth)
                    out.add(int(name), bool(null), ids + end, len(ids) // len(end) + 1)
                    if out.bytes >= roll:
                        yield out.finished()
                        out, nth = None, nth + 1
        if out is not None:
            yield out.finished()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(shards or partitions(spark), F.col("doc_id")).sortWithinPartitions(F.col("doc_id"), F.col("text"))
    found, base = [], 0
    for number, nth, n_docs, n_tokens, n_null in sorted(ranged.mapInArrow(shard, SHARD).collect()):
        found.append({"shard": f"{number:06d}-{nth:06d}", "n_docs": n_docs, "n_tokens": n_tokens, "n_null": n_null, "base": base})
        base += n_tokens
    manifest = {"width": np.dtype(code).itemsize, "tokens": base, "shards": found}
    temporary = f"{path}/_temporary/manifest-{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps(manifest).encode())
    place(fs, temporary, f"{path}/manifest.json")
    fs.delete_dir(f"{path}/_temporary")
    return manifest


class _Numbers:
    """A file of equal numbers: mapped where the store is a local or mounted disk, else read by ranges."""

    def __init__(self, fs: pafs.FileSystem, path: str, code: str):
        self.code, self.width = code, np.dtype(code).itemsize
        self.size = fs.get_file_info(path).size // self.width
        local = isinstance(fs, pafs.LocalFileSystem) and self.size
        self.file = pa.memory_map(path) if local else fs.open_input_file(path)

    def __getitem__(self, span: slice) -> np.ndarray:
        n = max(0, min(span.stop, self.size) - span.start)
        return np.frombuffer(self.file.read_at(n * self.width, span.start * self.width), self.code) if n else np.empty(0, self.code)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a committed folder: doc_id, global start, tokens and 32-bit ids."""
    fs, path = opened(folder)
    manifest = json.loads(fs.open_input_stream(f"{path}/manifest.json").read())
    shards, code = manifest["shards"], f"<u{manifest['width']}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for s in batch.to_pylist():
                stem = f"{path}/shard-{s['shard']}"
                ids, offsets, names = (_Numbers(fs, f"{stem}.{kind}", c) for kind, c in (("bin", code), ("off", "<i8"), ("doc", "<i8")))
                if not names.size == offsets.size - 1 == s["n_docs"] or ids.size != offsets[names.size : names.size + 1][0]:
                    raise ValueError(f"shard {s['shard']} disagrees with the manifest")
                # Batches of bounded tokens; one long document may exceed it.
                at = 0
                while at < names.size:
                    ends = offsets[at : at + 10_001]
                    n = max(1, min(int(np.searchsorted(ends, ends[0] + 2_000_000, "right")) - 1, len(ends) - 1))
                    ends = ends[: n + 1]
                    own, cuts = ids[int(ends[0]) : int(ends[-1])].astype("<u4"), (ends - ends[0]).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[at : at + n], mask=np.arange(at, at + n) < s["n_null"]),
                            pa.array(s["base"] + ends[:-1]),
                            pa.array(np.diff(ends)),
                            pa.array([own[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    at += n

    listed = spark.createDataFrame([(s["shard"], s["n_docs"], s["n_null"], s["base"]) for s in shards], "shard string, n_docs long, n_null long, base long")
    return listed.repartition(max(1, len(shards)), "shard").mapInArrow(rows, READ)


def query(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    write(table(spark, sf_dir, "documents"), folder)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
