"""Calibration: ranking quality over a grid of weights."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as C

COMPONENTS = tuple(C.IMPULSE_WEIGHTS)


def gain(relevance: Column, rank: Column) -> Column:
    return (F.pow(F.lit(2.0), relevance) - 1) / F.log2(rank + 1)


def ndcg(rows: DataFrame, keys: list[str], order: list, relevance: str, k: int = 10) -> DataFrame:
    """(keys, ndcg) of each ranking of ``rows``; 0 where nothing is relevant."""
    w = W.partitionBy(*keys)
    both = rows.withColumn("_p", F.row_number().over(w.orderBy(*order))).withColumn("_i", F.row_number().over(w.orderBy(F.desc(relevance))))
    rel = F.col(relevance)
    sums = both.groupBy(*keys).agg(F.sum(F.when(F.col("_p") <= k, gain(rel, F.col("_p"))).otherwise(0.0)).alias("dcg"), F.sum(F.when(F.col("_i") <= k, gain(rel, F.col("_i"))).otherwise(0.0)).alias("ideal"))
    return sums.select(*keys, F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0).alias("ndcg"))


def simplex(spark: SparkSession, resolution: float = 0.05) -> DataFrame:
    """(seq, five weights): all vectors of multiples of ``resolution`` that sum to 1, in lexical order.

    There are C(n + 4, 4) of them for n steps, 10,626 at 0.05; each row lists the rest of
    the steps by nested sequences, so nothing is crossed and filtered.
    """
    n = int(1 / resolution + 0.5)
    rows, left = spark.range(1), F.lit(n)
    names = []
    for name in COMPONENTS[:-1]:
        rows = rows.withColumn(f"_{name}", F.explode(F.sequence(F.lit(0), left)))
        names.append(f"_{name}")
        left = left - F.col(f"_{name}")
    last = rows.withColumn(f"_{COMPONENTS[-1]}", left)
    step = lambda name: (F.col(f"_{name}") / F.lit(float(n))).alias(name)
    # The place in lexical order is the vector read as a number in base n + 1.
    code = reduce(lambda a, c: a * (n + 1) + F.col(c), names, F.lit(0).cast("bigint"))
    return last.select(code.alias("seq"), *[step(c) for c in COMPONENTS])


def grid_search(examples: DataFrame, k: int = 10, resolution: float = 0.05) -> DataFrame:
    """(five weights, ndcg): the vector whose ranking of ``examples`` (seq, components, relevance) is best, the first on ties.

    Each vector ranks all examples.  Examples stay where they lie: each partition scores its
    own for all vectors, block by block, and passes on every vector's best k only; these
    are merged, k a vector and partition.  The ideal ranking is the same for every vector,
    so the greatest k relevances of all examples give it.  The vectors are a fixed table.
    """
    weights = simplex(examples.sparkSession, resolution).select("seq", *COMPONENTS)
    listed = weights.toPandas().sort_values("seq")  # C(n + 4, 4) rows, whatever the examples
    numbers, vectors = listed["seq"].to_numpy(), listed[list(COMPONENTS)].to_numpy()
    rated = examples.select(F.col("seq").cast("long").alias("example"), *[F.col(c).cast("double").alias(c) for c in COMPONENTS], F.col("relevance").cast("double").alias("relevance"))

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # for each vector its best so far: score, example, relevance
        for frame in frames:
            for start in range(0, len(frame), 1024):
                some = frame.iloc[start : start + 1024]
                parts = some[list(COMPONENTS)].to_numpy()
                score = np.zeros((len(vectors), len(some)))
                for n in range(len(COMPONENTS)):  # in the order of the components, as the sum is written
                    score = score + vectors[:, n : n + 1] * parts[None, :, n]
                shape = score.shape
                example, relevance = (np.broadcast_to(some[c].to_numpy(), shape) for c in ("example", "relevance"))
                if held is not None:
                    score, example, relevance = (np.concatenate([a, b], axis=1) for a, b in zip(held, (score, example, relevance), strict=True))
                order = np.lexsort((example, -score), axis=1)[:, :k]
                held = tuple(np.take_along_axis(a, order, 1) for a in (score, example, relevance))
        if held is not None:
            n = held[0].shape[1]
            yield pd.DataFrame({"seq": np.repeat(numbers, n), **{c: a.ravel() for c, a in zip(("score", "example", "relevance"), held, strict=True)}})

    few = rated.mapInPandas(best, "seq long, score double, example long, relevance double")
    nth = F.row_number().over(W.partitionBy("seq").orderBy(F.desc("score"), "example"))
    dcg = few.withColumn("_p", nth).filter(F.col("_p") <= k).groupBy("seq").agg(F.sum(gain(F.col("relevance"), F.col("_p"))).alias("dcg"))
    top = rated.select("relevance").orderBy(F.desc("relevance")).limit(k)
    ideal = top.withColumn("_i", F.row_number().over(W.orderBy(F.desc("relevance")))).agg(F.sum(gain(F.col("relevance"), F.col("_i"))).alias("ideal"))  # k rows
    found = dcg.join(F.broadcast(ideal)).withColumn("ndcg", F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(0.0))
    # Equal rankings may differ in the last bits by the order of their sums.
    return weights.join(found.select("seq", F.round("ndcg", 12).alias("ndcg")), "seq").orderBy(F.desc("ndcg"), "seq").limit(1).select("seq", *COMPONENTS, "ndcg")
