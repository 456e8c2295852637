"""Approximate nearest neighbours by collision counting.

Largest inner product becomes least Euclidean distance when every vector is
scaled by the greatest norm and given one more coordinate that brings it to
length one.  Each of ``PROJECTIONS`` random lines then gives a sorted array of
projected values.  Around a query's own values, windows of half-width
``HALF * R`` are opened in all arrays and the collisions of each vector are
counted; widening R reuses the arrays (virtual rehashing) and adds only what
the wider windows newly hold.  A vector that collides often enough is verified
by its exact inner product.  The search ends when as many verified vectors as
were asked for lie within R, because then every nearer one has passed the
threshold with high probability; there is no cap on candidates, and windows
that hold everything make the search exact.

Vectors lie in blocks of at most about ``BLOCK`` rows by a hash of their id,
and queries in blocks of about ``QUERIES``; each pair of blocks is one task of
bounded memory that builds the arrays of its vectors once for all its queries,
and only each query's best few per block go on.  With few queries to a block
of vectors, what is shuffled stays near the rows themselves: a vector goes once
to each block of queries, so twice up to some 1.3 million rows.

Defined results
  * a vector that is null, empty, zero, or holds a null or non-finite number,
    and one without an id take no part;
  * vectors of different lengths have no inner product: each is compared with
    those of its own length;
  * very small and very large numbers: lengths are taken after scaling by the
    largest component; where products may leave the range of a double, all
    vectors of the block are verified, so rounding to zero is a tie as any other;
  * ties in score go to the smaller vec_id;
  * repeated vec_ids: each row is a candidate; the query is the least vector;
  * fewer candidates than asked for: all of them; an empty table: no rows;
  * other columns are not used.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, table, written

NEIGHBOURS = 20
PROJECTIONS = 32
HALF = 1.0
#: A vector at distance R passes the threshold with this many standard deviations to spare.
SPARE = 1.6
#: R doubles from FIRST until it reaches the last step, then grows by it.
FIRST, STEP = 0.2, 0.2
#: More than twice the rounding error of a 32-bit inner product of unit vectors.
ROUGH = 1e-4
BLOCK = 65536
QUERIES = 32768
#: Blocks of vectors and of queries at least, so that small tables keep some cores busy.
LEAST = (4, 2)
#: Products of lengths within these bounds lose nothing that counts.
PLAIN = (1e-280, 1e280)
SEED = 20240501
FOUND = "query_id long, vec_id long, score double"


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, greatest: float, projections: int = PROJECTIONS):
        self.ids, self.vectors, self.greatest, self.m = ids, vectors, greatest, projections
        n, d = vectors.shape
        lines = np.random.default_rng(SEED).standard_normal((d + 1, projections))
        self.lines = lines[:d]
        scaled = vectors / greatest
        #: For ranking candidates; the few that may be among the best are scored exactly.
        self.rough = scaled.astype(np.float32)
        extra = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(1)))
        values = scaled @ self.lines + extra[:, None] * lines[d]
        order = np.argsort(values, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T).ravel()
        # One ascending array: each projection is moved behind the one before it.
        self.gap = 4.0 * (np.abs(values).max() + 8.0 * math.sqrt(d + 1))
        self.sorted = (np.take_along_axis(values, order, 0).T + self.gap * np.arange(projections)[:, None]).ravel()
        self.starts = n * np.arange(projections)
        likely = math.erf(HALF / math.sqrt(2.0))
        self.threshold = max(1, math.floor(projections * likely - SPARE * math.sqrt(projections * likely * (1.0 - likely))))

    def _exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        return (self.vectors[rows] * query).sum(1)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and inner products of the ``k`` nearest found, nearest first."""
        n, m = len(self.ids), self.m
        most = np.abs(query).max()
        unit = query / most
        length = math.sqrt((unit * unit).sum())
        unit /= length
        plain = PLAIN[0] < most * length * self.greatest < PLAIN[1]
        centre = unit @ self.lines + self.gap * np.arange(m)
        low = high = None
        count, verified = np.zeros(n, np.int64), np.zeros(n, bool)
        rows, rough, radius = np.empty(0, np.int64), np.empty(0, np.float32), FIRST if plain else math.inf
        unit = unit.astype(np.float32)
        while True:
            # Distances between unit vectors are at most 2; wider windows take in all.
            everything = radius > 2.0
            if everything:
                new = np.flatnonzero(~verified)
            else:
                lo = np.clip(np.searchsorted(self.sorted, centre - HALF * radius, "left"), self.starts, self.starts + n)
                hi = np.clip(np.searchsorted(self.sorted, centre + HALF * radius, "right"), self.starts, self.starts + n)
                low, high = (lo, lo) if low is None else (low, high)
                grown = [*zip(lo.tolist(), low.tolist(), strict=True), *zip(high.tolist(), hi.tolist(), strict=True)]
                parts = [self.order[a:b] for a, b in grown if a < b] or [self.order[:0]]
                low, high = lo, hi
                count += np.bincount(np.concatenate(parts), minlength=n)
                new = np.flatnonzero((count >= self.threshold) & ~verified)
            if len(new):
                verified[new] = True
                new = new[self.ids[new] != own]
                rows, rough = np.concatenate([rows, new]), np.concatenate([rough, self.rough[new] @ unit])
            if everything:
                break
            if len(rows) >= k:
                kth = np.partition(rough, len(rough) - k)[len(rough) - k]
                if 2.0 - 2.0 * kth <= radius * radius:
                    break
            radius += min(radius, STEP)
        if len(rows) > k and plain:
            rows = rows[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - ROUGH]
        scores = self._exact(rows, query)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and size(v) > 0")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(whole, F.lit(False)) & F.exists("v", lambda x: x != 0))


def neighbours(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id ``every`` divides."""
    rows = valid(vectors)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    norm = let(largest, lambda m: m * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / m) * (x / m))))
    # One row for each length of vectors.
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("greatest"), F.count_if(F.col("vec_id") % every == 0).alias("q"))
    blocks, parts = (F.greatest(F.lit(least), F.ceil(F.col(n) / per)).alias(name) for least, n, per, name in zip(LEAST, ("n", "q"), (block, queries), ("blocks", "parts"), strict=True))
    sizes = written(sizes.select("d", "greatest", blocks, parts), "ann-sizes")
    # Numbers that came as floats are shuffled as floats; widening them again is exact.
    v = F.col("v").cast(vectors.schema["embedding"].dataType).alias("v")
    place = lambda number, salt=0: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(number))
    each = lambda number: F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    left, right = (x.withColumn("d", F.size("v")).join(sizes, "d") for x in (rows, asked.withColumnRenamed("query_id", "vec_id")))
    left = left.select("d", "vec_id", v, "greatest", place("blocks").alias("block"), each("parts").alias("part"))
    right = right.select("d", "vec_id", v, place("parts", 1).alias("part"), each("blocks").alias("block"))

    def search(own: pa.Table, wanted: pa.Table) -> pa.Table:
        names, ids, scores = [], [], []
        if own.num_rows and wanted.num_rows:
            index = Block(own["vec_id"].to_numpy(), _matrix(own["v"]), own["greatest"][0].as_py())
            for name, query in zip(wanted["vec_id"].to_pylist(), _matrix(wanted["v"]), strict=True):
                found, score = index.search(name, query, k)
                names.append(np.full(len(found), name))
                ids.append(found)
                scores.append(score)
        join = lambda xs, kind: pa.array(np.concatenate(xs) if xs else np.empty(0), kind)
        return pa.table({"query_id": join(names, pa.int64()), "vec_id": join(ids, pa.int64()), "score": join(scores, pa.float64())})

    best = left.groupBy("d", "block", "part").cogroup(right.groupBy("d", "block", "part")).applyInArrow(search, FOUND)
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", nth).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
