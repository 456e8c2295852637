"""Spelling variant grouping: words one letter apart, and the common form of each.

Two words that differ by a replaced letter share the word with that place left
open: (position, prefix, suffix).  Two words that differ by an inserted letter
share the shorter of them.  So every word stands in one group for each of its
places, and in one for itself and for each deletion of a letter.  A group
keeps its size and its two best words, and each member learns from these how
many words are near it there and which is best; pairs are never made.  Two
words share one group at most, so sizes add up to the number of near words.

A group is named by a polynomial of its letters modulo 2 ** 127 - 1, which one
pass over a word gives for all its places, so long words cost what their length
is.  Words travel as their rank (most frequent first, then code points), so
"best" is "least".  No group can be large: words that differ in one place are
no more than the alphabet, some 120 letters, and those that shorten to one word
no more than its places times the alphabet.

Counting sums a task's words before the shuffle, so frequent words are one row
a task and flush.

Defined results
  * null and empty texts have no words; an empty table gives no rows;
  * a null doc_id is written as nothing before the colon;
  * repeated rows: each counts; rows of equal doc_id and word lose the same letter;
  * ties: of near words with equal n the smallest in code points is the form;
  * very long texts are read word by word; very long words need memory in
    proportion to their length;
  * other columns are not used.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch, table, written
from .tokens import slices

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
#: A form has at least so many times the word's occurrences.
RATIO = 5
#: One of so many (document, word) numbers loses a letter.
DAMAGE = 199

#: Distinct words that a task sums before it passes them on.
HELD = 200_000
#: Texts beyond this length are read by an iterator, not as a list of words.
LONG_TEXT = 1 << 20
PRIME = (1 << 127) - 1
BASE = 0x5BD1E9955BD1E9959E3779B97F4A7C15 % PRIME
#: Groups of words that differ in one place, and of words that shorten to one.
OPEN, STRING = 0, 1


def counted(docs: DataFrame, min_chars: int = MIN_CHARS, damage: int | None = DAMAGE, text: str = "text") -> DataFrame:
    """(word, n): words of all texts; with ``damage`` some lose the letter that their document's number names."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col(text).cast("string").alias("text"))
    run = re.compile(f"[{LETTERS}]{{{min_chars},}}")  # shorter runs can't give a word

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[str] = Counter()

        def summed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])
            sums.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for doc, whole in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    if not whole:
                        continue
                    whole = whole.encode().lower().decode()  # of bytes, so A-Z alone
                    runs = run.findall(whole) if len(whole) < LONG_TEXT else map(operator.itemgetter(0), run.finditer(whole))
                    of_doc = zlib.crc32(f"{doc}:".encode())
                    for word, n in Counter(runs).items():
                        if damage and (h := zlib.crc32(word.encode(), of_doc)) % damage == 0:
                            word = word[: h % len(word)] + word[h % len(word) + 1 :]
                            if len(word) < min_chars:
                                continue
                        sums[word] += n
                    if len(sums) > HELD:
                        yield summed()
        yield summed()

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int | None = DAMAGE, text: str = "text") -> DataFrame:
    """(rank, word, n) of words that are frequent enough, stored; ranks rise from the most frequent, ties by code points."""
    kept = counted(docs, min_chars, damage, text).filter(F.col("n") >= min_count)
    return written(kept.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("rank"), "word", "n"), "spelling-words")


def group_numbers(word: str, powers: list[int]) -> tuple[int, list[int], list[int]]:
    """The number of ``word``, of it with each place left open, and of its distinct shortenings by a letter."""
    letters = [ord(c) for c in word]
    while len(powers) < len(letters):
        powers.append(powers[-1] * BASE % PRIME)
    before = [0]
    for c in letters:
        before.append((before[-1] * BASE + c) % PRIME)
    whole, last = before[-1], len(letters) - 1
    opened = [(whole - c * powers[last - p]) % PRIME for p, c in enumerate(letters)]
    # Of equal letters side by side any may go: the first stands for all.
    shorter = [(whole + (before[p] - before[p + 1]) * powers[last - p]) % PRIME for p, c in enumerate(letters) if not p or c != letters[p - 1]]
    return whole, opened, shorter


def memberships(words: DataFrame) -> DataFrame:
    """(kind, high, low, rank, own): the groups of each word; ``own`` marks a word in the group of itself."""
    schema = pa.schema([("kind", pa.int8()), ("high", pa.int64()), ("low", pa.int64()), ("rank", pa.int64()), ("own", pa.bool_())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [1]
        for batch in batches:
            for part in slices(batch, "word"):
                rows: list[tuple[int, int, int, bool]] = []

                def grouped() -> pa.RecordBatch:
                    kinds, values, ranks, own = zip(*rows, strict=True)
                    low = [(v & 0xFFFFFFFFFFFFFFFF) - (1 << 63) for v in values]
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((kinds, [v >> 64 for v in values], low, ranks, own), schema.types, strict=True)], schema=schema)  # noqa: B023

                for word, rank in zip(part["word"].to_pylist(), part["rank"].to_pylist(), strict=True):
                    whole, opened, shorter = group_numbers(word, powers)
                    rows.append((STRING, whole, rank, True))
                    rows += [(OPEN, v, rank, False) for v in opened]
                    rows += [(STRING, v, rank, False) for v in shorter]
                    if len(rows) > HELD:
                        yield grouped()
                        rows.clear()
                if rows:
                    yield grouped()

    return words.select("word", "rank").mapInArrow(number, "kind tinyint, high long, low long, rank long, own boolean")


def near_words(words: DataFrame) -> DataFrame:
    """(rank, n_near, best): how many words are near each word that has any, and the least rank of them."""
    group = W.partitionBy("kind", "high", "low").orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    own, col = F.col("own"), F.col
    summed = memberships(words).select(
        "kind", "rank", "own",
        F.count("*").over(group).alias("size"), F.min("rank").over(group).alias("first"), F.nth_value("rank", 2).over(group).alias("second"),
        F.min(F.when(own, col("rank"))).over(group).alias("self"), F.min(F.when(~own, col("rank"))).over(group).alias("longer"),
    )
    open_ = col("kind") == OPEN
    n = F.when(open_, col("size") - 1).when(own, col("size") - 1).otherwise(col("self").isNotNull().cast("long"))
    best = F.when(open_, F.when(col("rank") == col("first"), col("second")).otherwise(col("first"))).when(own, col("longer")).otherwise(col("self"))
    return summed.select("rank", n.alias("n"), best.alias("best")).filter("n > 0").groupBy("rank").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def formed(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(rank, word, n, n_near, form_rank, form, form_n) of every word; the form is null where no near word is ``ratio`` times as frequent."""
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    rows = words.join(near_words(words).join(best, "best"), "rank", "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    kept = lambda c, name: F.when(fits, F.col(c)).alias(name)
    return rows.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), kept("best", "form_rank"), kept("form", "form"), kept("form_n", "form_n"))


def rooted(words: DataFrame) -> DataFrame:
    """``formed`` rows with ``root``, the last of a word's chain of forms.

    Roots go down the chains, a step a round: a form's rows are those near it, so no round
    has a hot key, and a step divides n by the ratio, so there are few rounds.
    """
    spark, done = words.sparkSession, []
    reached = words.filter("form_rank is null").select(F.col("rank").alias("form_rank"), F.col("word").alias("root"))
    waiting = words.filter("form_rank is not null").select("rank", "form_rank")
    while True:
        done.append(reached.withColumnRenamed("form_rank", "rank"))
        if waiting.isEmpty():
            break
        path = scratch(spark, "spelling-roots")
        waiting.join(reached, "form_rank", "left").write.parquet(path)
        stepped = spark.read.schema("form_rank long, rank long, root string").parquet(path)
        reached = stepped.filter("root is not null").select(F.col("rank").alias("form_rank"), "root")
        waiting = stepped.filter("root is null").select("rank", "form_rank")
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return words.join(roots, "rank")


def grouped(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, damage: int | None = None, text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word of ``docs``."""
    words = vocabulary(docs, min_chars, min_count, damage, text)
    return rooted(written(formed(words, ratio), "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"), damage=DAMAGE)
