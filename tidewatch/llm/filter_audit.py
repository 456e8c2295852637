"""Filter interaction audit: what five filters take away in every order.

A batch's texts are one buffer of bytes.  A table gives each byte its classes
(word, capital, symbol, first byte of a code point); prefix sums over the
buffer, read at the documents' offsets, give the counts.  Distinct words come
from 48-bit word hashes, sorted within each document: neighbours of one hash
are compared byte by byte, and a document where two words share a hash is
counted anew by its words.  Each document becomes a mask of the filters that
it fails; the counts of masks hold all that any order of filters can ask, so
the 120 orders are computed from at most 32 rows a part.

Copies are found by the text's 128-bit digest.  Rows of one digest are summed
by part, mask and labels before they meet, so a text that most rows hold is a
few rows; of each sum only the least doc_id isn't a copy.

Defined results
  * null text: empty, like any other empty text; null lang: the part '';
  * no words: filter B holds (0 < 0 is false);
  * a row without a doc_id has no smaller one: it is never a copy, and makes
    no other row one; it has no labels;
  * repeated rows: each counts; rows of the least doc_id of a text are no copies;
  * several labels of a doc_id: one that says 1 is enough;
  * long texts are scanned in blocks; what is kept of one is three numbers a word;
  * an empty table has no parts and gives no rows; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10

WORD, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8
_BYTES = np.arange(256)
#: The classes of each byte; words are what blanks (space, tab to carriage return) part.
CLASSES = (
    np.where((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)), 0, WORD)
    | np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), CAPITAL, 0)
    | np.where(np.isin(_BYTES, list(b"#$%&*|")), SYMBOL, 0)
    | np.where((_BYTES & 0xC0) != 0x80, POINT, 0)
).astype(np.uint8)

#: Bytes scanned at a time, and documents of a group at most (16 bits of a word's key).
BLOCK, DOCUMENTS = 1 << 20, 1 << 16
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Scanner:
    """Counts words, distinct words, capitals, symbols and code points of documents that lie in one buffer."""

    def __init__(self):
        self.power, self.back = _powers(BASE), _powers(INVERSE)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows (words, distinct words, capitals, symbols, code points) for the documents between ``offsets``."""
        out = np.zeros((len(offsets) - 1, 5), np.int64)
        first = 0
        while first < len(out):
            last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
            last = min(max(last, first + 1), first + DOCUMENTS, len(out))
            self._group(data, offsets[first : last + 1], out[first:last])
            first = last
        return out

    def _group(self, data: np.ndarray, bounds: np.ndarray, out: np.ndarray) -> None:
        starts, ends, inside = [], [], False
        for low in range(int(bounds[0]), int(bounds[-1]), BLOCK):
            high = min(low + BLOCK, int(bounds[-1]))
            classes = CLASSES[data[low:high]]
            cut = np.clip(bounds - low, 0, high - low)
            for column, bit in ((2, CAPITAL), (3, SYMBOL), (4, POINT)):
                sums = np.concatenate(([0], np.cumsum((classes & bit) != 0, dtype=np.int32)))
                out[:, column] += np.diff(sums[cut])
            word = (classes & WORD) != 0
            before = np.concatenate(([inside], word[:-1]))
            opens = np.zeros(high - low, bool)
            opens[bounds[(bounds >= low) & (bounds < high)] - low] = True
            starts.append(np.flatnonzero(word & (~before | opens)) + low)
            ends.append(np.flatnonzero(before & (~word | opens)) + low)
            inside = bool(word[-1])
        if inside:
            ends.append(bounds[-1:])
        if not starts:
            return
        start, end = np.concatenate(starts), np.concatenate(ends)
        out[:, 0] = words = np.diff(np.searchsorted(start, bounds))
        out[:, 1] = self._distinct(data, start, end, words)

    def _hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A polynomial of each word's bytes modulo 2 ** 64, stirred, from prefix sums over a block."""
        out, i = np.empty(len(start), np.uint64), 0
        while i < len(start):
            low = int(start[i])
            j = int(np.searchsorted(end, low + BLOCK, "right"))
            if j == i:  # one word longer than a block
                whole, j = 0, i + 1
                for at in range(low, int(end[i]), BLOCK):
                    part = data[at : min(at + BLOCK, int(end[i]))].astype(np.uint64) + np.uint64(1)
                    whole += int(np.sum(part * self.power[: len(part)], dtype=np.uint64)) * pow(BASE, at - low, 1 << 64)
                out[i] = whole % (1 << 64)
            else:
                part = data[low : int(end[j - 1])].astype(np.uint64) + np.uint64(1)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * self.power[: len(part)], dtype=np.uint64)))
                out[i:j] = (sums[end[i:j] - low] - sums[start[i:j] - low]) * self.back[start[i:j] - low]
            i = j
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        return out

    def _distinct(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray) -> np.ndarray:
        doc = np.repeat(np.arange(len(words), dtype=np.uint64), words)
        key = (self._hashes(data, start, end) >> np.uint64(16)) | (doc << np.uint64(48))
        order = np.argsort(key)
        key = key[order]
        twin = np.flatnonzero(key[1:] == key[:-1])
        a, b = order[twin], order[twin + 1]
        of = doc[a].astype(np.int64)
        out = words - np.bincount(of, minlength=len(words))
        for d in np.unique(of[~self._equal(data, start, end, a, b)]):  # two words of one hash
            mine = np.flatnonzero(doc == d)
            out[d] = len({data[s:e].tobytes() for s, e in zip(start[mine], end[mine], strict=True)})
        return out

    def _equal(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a[i] and b[i] are the same bytes."""
        length = end[a] - start[a]
        same = length == end[b] - start[b]
        todo = np.flatnonzero(same)
        total = np.cumsum(length[todo])
        i = 0
        while i < len(todo):
            done = int(total[i - 1]) if i else 0
            j = int(np.searchsorted(total, done + BLOCK, "right"))
            if j == i:  # one pair longer than a block
                k, j = todo[i], i + 1
                same[k] = np.array_equal(data[start[a[k]] : end[a[k]]], data[start[b[k]] : end[b[k]]])
            else:
                some, n = todo[i:j], length[todo[i:j]]
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                bad = data[np.repeat(start[a[some]], n) + at] != data[np.repeat(start[b[some]], n) + at]
                same[some[np.searchsorted(np.cumsum(n), np.flatnonzero(bad), "right")]] = False
            i = j
        return same


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts, without a copy of either where nothing is null."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def masks(docs: DataFrame, min_words: int = MIN_WORDS, distinct_percent: int = DISTINCT_PERCENT, capital_percent: int = CAPITAL_PERCENT) -> DataFrame:
    """(doc_id, part, mask, digest): bits 0 to 3 of ``mask`` are the filters A to D that the text fails."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            data, bounds = buffers(batch["text"])
            words, distinct, capitals, symbols, points = scanner(data, bounds).T
            fails = (words < min_words, 100 * distinct < distinct_percent * words, 100 * capitals > capital_percent * points, symbols > 0)
            mask = sum(np.where(f, 1 << bit, 0) for bit, f in enumerate(fails))
            digests = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = [batch["doc_id"], batch["part"], pa.array(mask, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])

    return rows.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, mask int, digest binary")


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail, bit 4 for copies of a smaller doc_id."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    said = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    rows = masked.join(known, "doc_id", "left").select("digest", "part", "mask", said("good"), said("toxic"), "doc_id")
    kind = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    sums = by_id.groupBy(*kind, F.col("doc_id").isNull().alias("nameless")).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"))
    first = F.min("least").over(W.partitionBy("digest"))
    copies = F.when(F.col("nameless"), F.lit(0)).when(F.col("least") == F.col("first"), F.col("n") - F.col("n_least")).otherwise(F.col("n"))
    split = sums.withColumn("first", first).select("part", "mask", "good", "toxic", "n", copies.alias("copies"))
    some = split.select("part", "good", "toxic", F.explode(F.array(F.struct("mask", (F.col("n") - F.col("copies")).alias("n")), F.struct((F.col("mask") + 16).alias("mask"), F.col("copies").alias("n")))).alias("m"))
    part_of = lambda c: F.sum(F.when(F.col(c), F.col("m.n")).otherwise(0)).alias(c)
    return some.filter("m.n > 0").groupBy("part", F.col("m.mask").alias("mask")).agg(F.sum("m.n").alias("n"), part_of("good"), part_of("toxic"))


def audited(counts: DataFrame) -> DataFrame:
    """What each step of each order does, from ``mask_counts``: one row a part, order and step."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [("".join(p), k + 1, sum(bit[f] for f in p[:k]), bit[f]) for p in permutations(FILTERS) for k, f in enumerate(p)]
    table_ = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, own int")
    fixed = table_.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(31))))  # 19,200 rows whatever the input
    met = counts.join(F.broadcast(fixed), "mask")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda where, c, name: F.sum(F.when(where, F.col(c)).otherwise(0)).cast("long").alias(name)
    # Of the orders, one in each number of failed filters meets this filter first.
    share = F.sum(F.when(fails, F.expr("n * (120 div greatest(bit_count(mask), 1))")).otherwise(0)).cast("long").alias("shapley")
    return met.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, "n", "kept"), total(fails & ~gone, "n", "removed"), total(fails & gone, "n", "redundant"), total(F.col("mask") == F.col("own"), "n", "unique_fails"),
        total(fails & ~gone, "good", "good_lost"), total(fails & ~gone, "toxic", "toxic_lost"), share,
    )


def query(spark, sf_dir: str) -> DataFrame:
    return audited(mask_counts(masks(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")))


def oracle() -> str:
    """DuckDB SQL for ``query``."""
    letters = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(FILTERS))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
c AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, (len(ws) < {MIN_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < {DISTINCT_PERCENT} * len(ws))::INT
           + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {CAPITAL_PERCENT} * length(t))::INT
           + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > least, false)::INT AS mask,
         coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
  FROM d JOIN c USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
b(x, bit) AS (VALUES {letters}),
o AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM b p, b q, b r, b s, b t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
    AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, range(1, 6) AS r(step)),
x AS (SELECT *, mask & own <> 0 AS fails, mask & earlier <> 0 AS gone FROM m, s)
SELECT part, filter_order, step::INT AS step,
       coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (fails), 0)::BIGINT AS shapley
FROM x GROUP BY part, filter_order, step"""
