"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    It is the session's ``spark.checkpoint.dir``.  Only where that is unset and
    the driver is the only executor (tests) a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.getCheckpointDir():
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
        root = context.getCheckpointDir()
    # With its scheme, so that Python's file systems mean the same store as Spark does.
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().toString().rstrip("/")


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Removes what operators of this process wrote to the shared folder; results read from there end with it."""
    context, n = spark.sparkContext, 0
    while _SCRATCH:
        path = context._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True))
    return n


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read again.

    Cuts lineage durably: the rows survive the loss of any executor, and no
    later stage evaluates ``df`` a second time.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once for each row.

    The optimizer may inline a projected column into every lambda call that
    mentions it; binding it as a lambda variable rules that out.
    """
    return F.transform(F.array(value), body)[0]


#: A key is hot if it holds more than one of so many rows; hence fewer than so many keys are hot, however many rows there are.
HOT_SHARE = 10_000


def met(rows: DataFrame, facts: DataFrame, key: list[str], weight: str) -> DataFrame:
    """``rows`` with the columns of ``facts``, one fact a key at most; rows without a fact get nulls.

    ``weight`` tells how many rows hold a key.  Facts of hot keys are broadcast, at most
    ``HOT_SHARE`` of them, so no task gets a hot key's rows; the others meet by a shuffle.
    Both should be stored, since each is read twice.
    """
    total = facts.agg(F.sum(weight).alias("n")).first()["n"] or 0
    heavy, mark = F.col(weight) * HOT_SHARE > F.lit(total), unused(rows, "_hot")
    hot = facts.filter(heavy).drop(weight).withColumn(mark, F.lit(True))
    wide = rows.join(F.broadcast(hot), key, "left")
    kept = [F.col(f"`{c}`") for c in rows.columns]
    rest = wide.filter(F.col(mark).isNull()).select(*kept).join(facts.filter(~heavy).drop(weight), key, "left")
    return wide.filter(F.col(mark).isNotNull()).drop(mark).unionByName(rest)


#: Words of 64 bits in a sieve: its size whatever the rows, so it is broadcast.
SIEVE = 1 << 18


def sifted(rows: DataFrame, few: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key may be one of ``few``'s, and those whose key surely is none of them.

    Each key of ``few`` sets one of ``64 * SIEVE`` bits by its hash, nulls as any value.  Only rows that
    hit a set bit need an exact join; where bits are all set, as ``few`` grows, that is every row.
    """
    place, word, bits = (unused(rows, name) for name in ("_place", "_word", "_bits"))

    def placed(df: DataFrame) -> DataFrame:
        at = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(few.schema[k].dataType) for k in key]), F.lit(64 * SIEVE))
        return df.withColumn(place, at).withColumn(word, F.shiftright(place, 6)).withColumn(place, F.pmod(place, F.lit(64)).cast("int"))

    known = placed(few).groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, {place})")).alias(bits))
    wide = placed(rows).join(F.broadcast(written(known, "sieve")), word, "left")
    hit = F.coalesce(F.getbit(bits, place), F.lit(0)) == 1
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return wide.filter(hit).select(*kept), wide.filter(~hit).select(*kept)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names the caller is about to add."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
