"""Connected components by alternating stars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A node is a hub if it holds more than one of so many links, so there are fewer hubs than this.
HUBS = 2_000
#: Nodes of a partition that a task unites at a time.
UNITED = 500_000


def forest(edges: DataFrame) -> DataFrame:
    """(a, b): each partition's edges less those that its other edges imply, by union-find; every node stays.

    What is left of a partition is one edge a node at most, to the least node of its kind there, so
    repeated edges, cliques and chains that lie together end before the first shuffle.
    """
    kind = edges.schema["a"].dataType.simpleString()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, of = {}, None

        def root(x):
            while above.setdefault(x, x) != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        def united() -> pa.RecordBatch:
            nodes = list(above)
            out = pa.RecordBatch.from_arrays([pa.array(nodes, of), pa.array([root(x) for x in nodes], of)], names=["a", "b"])
            above.clear()
            return out

        for batch in batches:
            of = batch["a"].type
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
            if len(above) > UNITED:
                yield united()
        if above:
            yield united()

    return edges.select("a", "b").mapInArrow(unite, f"a {kind}, b {kind}")


def _met(rows: DataFrame, facts: DataFrame, total: int) -> DataFrame:
    """``rows`` joined with ``facts`` (a, n, ...), one fact an ``a``, where ``n`` rows hold it.

    Facts of hubs are broadcast, fewer than ``HUBS`` of them, so a hub's rows stay where they are.
    """
    hub = F.col("n") * HUBS > total
    hubs = facts.filter(hub).drop("n")
    wide = rows.join(F.broadcast(hubs.withColumn("_hub", F.lit(True))), "a", "left")
    rest = wide.filter("_hub is null").select("a", "b").join(facts.filter(~hub).drop("n"), "a")
    return wide.filter("_hub").drop("_hub").unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b): root is the component's least node; edges that name no node are left out.

    Partitions unite their own edges first.  Then each round links every node to the
    least it knows, first upward (to all larger neighbours), then downward; diameter
    shrinks by a power each time, and rounds go on until one changes nothing.  Least
    nodes are taken before the shuffle and reach a hub's links by a broadcast, so a
    node of very many links is no task's burden.  Rounds are saved, so lineage stays
    short and survives lost executors.
    """
    edges = saved(forest(edges.filter("a is not null and b is not null")))  # read again for the nodes

    def tidy(df: DataFrame) -> DataFrame:
        return df.filter("a != b").distinct()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # An edge to itself keeps lone nodes.
    nodes = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    links = saved(tidy(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    before, now = None, mark(links)
    while now != before and now[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n")))
        large = saved(tidy(_met(both.filter("b > a"), least, now[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))))
        down = saved(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = _met(large, down, now[0]).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        links = saved(tidy(small))
        before, now = now, mark(links)
    return nodes.join(links.select(F.col("a").alias("id"), F.col("b").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def saved(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the checkpoint folder, read again: cuts lineage as ``checkpoint`` does.

    Rounds need this one: a checkpoint keeps the size that its plan was guessed to have, so the guesses
    of many rounds multiply until planning takes longer than the work; files have their true size.
    """
    spark = df.sparkSession
    ready(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/saved-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark) -> None:
    """Makes sure there is a checkpoint folder: the session's own, or a temporary one where the driver is the only executor (tests)."""
    import re
    import tempfile

    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tidewatch-"))
