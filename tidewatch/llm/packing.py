"""Packing: concatenate documents and cut the stream into fixed windows.

Two passes.  The first encodes every document once, and stores its ids with
its start inside its partition.  The token totals of partitions (one number a
partition, the only thing that reaches the driver) become bases by a prefix
sum; a base plus a local start is a global offset.  The second pass cuts each
document at multiples of the window, independently of all others: a document
over a boundary gives one piece on each side.  No row of ids is ever shuffled,
so a document of any length or a hot source costs only its own tokens.

Defined results
  * null text: empty, thus the end id alone (one piece of length 1);
  * documents follow each other in the order in which the input is scanned,
    repeated rows and null doc_ids included: each row is packed;
  * an empty table gives no pieces;
  * only the last window is short, so padding is under one window in all;
  * columns other than doc_id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .tokens import encoder_for, forget, slices

WINDOW = 2048
END_ID = 1
TOKENS = "part int, doc_id long, local_start long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, spaced: bool = True) -> DataFrame:
    """First pass: ids (16-bit while they fit, see ``id_code``) with starts local to the partition."""
    code = id_code(tokenizer, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_for(tokenizer, spaced, code), np.array([end_id], code).tobytes()
        part, at, width = TaskContext.get().partitionId(), 0, len(end)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids = [i + end for i in encoder(rows["text"].to_pylist())]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
                ends = at + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), rows["doc_id"], pa.array(ends - sizes), pa.array(sizes), pa.array(ids, pa.binary())],
                    names=["part", "doc_id", "local_start", "n_tokens", "ids"],
                )
                at = int(ends[-1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, TOKENS)


@lru_cache(maxsize=4)
def id_code(tokenizer: str, end_id: int) -> str:
    """'H' where 16 bits hold every id, else 'I'."""
    from tokenizers import Tokenizer

    return "H" if max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else "I"


def bases(tokens: DataFrame) -> dict[int, int]:
    """Prefix sums of the partitions' token totals: one entry a partition."""
    totals = sorted(tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    out, at = {}, 0
    for part, n in totals:
        out[part] = at
        at += n
    return out


def cut(tokens: DataFrame, window: int = WINDOW, code: str = "H") -> DataFrame:
    """Second pass: the pieces of every document, with ids as 32-bit little-endian."""
    base = bases(tokens)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in slices(whole, "ids"):
                starts = np.array([base[p] for p in batch["part"].to_pylist()], np.int64) + batch["local_start"].to_numpy()
                sizes = batch["n_tokens"].to_numpy()
                first, last = starts // window, (starts + sizes - 1) // window
                counts = last - first + 1
                doc = np.repeat(np.arange(len(sizes)), counts)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                sequence = first[doc] + nth
                begin = np.maximum(sequence * window, starts[doc])
                end = np.minimum((sequence + 1) * window, starts[doc] + sizes[doc])
                local = begin - starts[doc]
                raw = [np.frombuffer(b, code) for b in batch["ids"].to_pylist()]
                ids = [raw[d][a:b].astype("<u4").tobytes() for d, a, b in zip(doc.tolist(), local.tolist(), (end - starts[doc]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(doc)), pa.array(local), pa.array(end - begin), pa.array(sizes[doc]), pa.array(sequence), pa.array(begin - sequence * window), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return tokens.mapInArrow(pieces, PIECES)


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID, spaced: bool = True) -> DataFrame:
    """Pieces of ``docs``: where each lies in its document and in its sequence, and its ids."""
    tokenizer = tokenizer or default_tokenizer()
    tokens = written(encoded(docs, tokenizer, end_id, spaced), "packing", compression="zstd")
    return cut(tokens, window, id_code(tokenizer, end_id))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Whole training sequences (sequence_id, ids, length), the last one padded unless its length is a power of two."""
    ordered = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("p"), F.sum("length").alias("length"))
    joined = F.array_join(F.transform("p", lambda x: x["ids"]), "")
    spare = F.when(F.bit_count("length") == 1, 0).otherwise(window - F.col("length")).cast("int")
    return ordered.select("sequence_id", "length", F.unhex(F.concat(joined, F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), spare))).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(packed(table(spark, sf_dir, "documents")))
