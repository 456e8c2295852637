"""Incremental ingestion: interval file pairs, by a stream or by a bounded catch-up, each interval through the store.

Both go by the same mark, the last interval that a successful run notes: what one did, the other passes over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.values import interval_start
from ..operators.normalize import typed_events
from ..plans.ingest import ingest_batch, ranking_tick
from ..sources.feeds import article_titles, complete_intervals, raw_events
from ..sources.intervals import ARTICLES, EXPORT, IntervalSource
from ..sources.store import Store

STAMP = r"(\d{14})\.[^/]*$"


def numbered(rows: DataFrame) -> DataFrame:
    """With ``seq``, the order of lines: interval, then place in the file as scanned."""
    return rows.withColumn("seq", F.monotonically_increasing_id())


def process(store: Store, events: DataFrame, articles: DataFrame, now, interval: str | None = None) -> dict[str, int]:
    """One batch of raw lines (value): parse, keep what is relevant, store, rank; logged as a run, with its interval."""
    typed = typed_events(raw_events(numbered(events.select("value")))).filter("relevant").drop("relevant")
    run, spark = f"run-{uuid.uuid4().hex}", store.spark
    stamp = now if now is not None else F.current_timestamp()

    def log(status: str, counts: dict | None, error: str | None) -> None:
        row = spark.range(1).select(
            F.lit(run).alias("id"), stamp.alias("started_at"), (F.lit(None).cast("timestamp") if status == "running" else F.current_timestamp()).alias("finished_at"), F.lit("score").alias("stage"),
            F.lit(status).alias("status"), F.lit(None if counts is None else json.dumps(counts)).cast("string").alias("counts_json"), F.lit(error).cast("string").alias("error"),
        )
        store.change("ingest_runs", row)

    log("running", None, None)
    try:
        counts = ingest_batch(store, typed, article_titles(numbered(articles.select("value")), "seq"), stamp)
        counts["ranked"] = ranking_tick(store, stamp)
    except Exception as error:
        log("failed", None, str(error)[:500])
        raise
    log("success", counts if interval is None else counts | {"last_interval": interval}, None)
    return counts


def high_water(store: Store, first: str) -> str:
    """The last interval that a successful run did, else ``first``."""
    done = store.read("ingest_runs").filter("status = 'success'").select(F.get_json_object("counts_json", "$.last_interval").alias("ts"))
    return done.agg(F.max("ts")).first()[0] or first


def cold_start(now) -> object:
    """The interval that a first run starts after: the look-back before now."""
    return interval_start(now - F.make_dt_interval(mins=F.lit(C.LOOKBACK_INTERVALS * C.INTERVAL_MINUTES)))


def pending(spark: SparkSession, exports: str, articles: str, after: str, limit: int = C.MAX_INTERVALS) -> list[str]:
    """Intervals to do now: complete pairs without a gap, at most ``limit``."""
    listed = lambda path, glob: spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.regexp_extract("path", STAMP, 1).alias("ts"))
    found = complete_intervals(listed(exports, "*.export.CSV"), listed(articles, "*.gkg.csv"), after, limit)
    return [r["ts"] for r in found.collect()]  # at most ``limit`` rows


def _interval(store: Store, export_path: str, article_path: str, now, ts: str) -> dict:
    lines = store.spark.read.option("lineSep", "\n")
    return process(store, lines.text(export_path), lines.text(article_path), now, ts) | {"ts": ts}


def run_pending(store: Store, exports: str, articles: str, first: str, now=None, limit: int = C.MAX_INTERVALS) -> list[dict]:
    """Bounded catch-up: each pending interval in order."""
    return [_interval(store, f"{exports}/{EXPORT.format(ts=ts)}", f"{articles}/{ARTICLES.format(ts=ts)}", now, ts) for ts in pending(store.spark, exports, articles, high_water(store, first), limit)]


def stream(store: Store, exports: str, articles: str, checkpoint: str, first: str, now=None, on_batch: Callable[[int, dict], None] | None = None, limit: int = C.MAX_INTERVALS, trigger: dict | None = None):
    """Starts a query that ingests complete intervals as they come; by default it takes those that are there and stops.

    A new stream starts behind the mark; one that starts again goes by its checkpoint, and passes
    over what the mark says is done, whoever did it.  An interval that was cut off is done again,
    which changes nothing but what it lacked.
    """

    def each(batch: DataFrame, number: int) -> None:
        mark = high_water(store, first)
        for row in batch.orderBy("ts").collect():  # at most ``limit`` rows: names of intervals
            if row["ts"] > mark:
                counts = _interval(store, row["export_path"], row["article_path"], now, row["ts"])
                if on_batch:
                    on_batch(number, counts)

    store.spark.dataSource.register(IntervalSource)
    options = {"exports": exports, "articles": articles, "after": high_water(store, first), "limit": str(limit)}
    intervals = store.spark.readStream.format(IntervalSource.name()).options(**options).load()
    return intervals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
