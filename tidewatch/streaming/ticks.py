"""Periodic work as a stream: each micro-batch is a tick that runs the jobs that are due.

A job runs once in each slot of its period, at the first tick that falls into it, so a
job of an hour runs in the first minutes of the hour.  The last moment of each job lies
in the store (``kept_ticks``): a stream that starts again goes on where it was, a slot
that no tick fell into is passed over, and a job that fails is tried again by the next
tick and keeps no other job from running.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..plans.ingest import quote_retention, ranking_tick
from ..plans.notify import Sender, alert_tick, watch_tick
from ..sources.push import PAUSE_SECONDS
from ..sources.store import Store

#: Minutes between two runs of each standard job.
PERIODS = {"alerts": 5, "watches": 5, "ranking": C.INTERVAL_MINUTES, "retention": 60}


@dataclass(frozen=True)
class Job:
    """``run`` gets the tick's moment and must bear being run twice for it."""

    name: str
    minutes: int
    run: Callable[[Column], object]


def standard(store: Store, sender: Sender, pause: float = PAUSE_SECONDS) -> list[Job]:
    """Alerts and watches by ``sender``, ranking, and the retention of quotes; ranking comes first, so that alerts see its scores."""
    runs = {
        "ranking": lambda now: ranking_tick(store, now),
        "retention": lambda now: quote_retention(store, now),
        "alerts": lambda now: alert_tick(store, sender, now, pause),
        "watches": lambda now: watch_tick(store, sender, now, pause=pause),
    }
    return [Job(name, PERIODS[name], run) for name, run in runs.items()]


def slot(seconds: Column, minutes: Column) -> Column:
    """Number of the period that holds a moment (seconds since the epoch)."""
    return F.floor(seconds / (minutes * 60))


def due_ticks(moments: DataFrame, periods: dict[str, int] = PERIODS) -> DataFrame:
    """(job, at): which of ``moments`` (at) run which job: the first in each slot.  Null moments are no ticks."""
    jobs = F.explode(F.array(*[F.struct(F.lit(name).alias("job"), F.lit(minutes).alias("minutes")) for name, minutes in periods.items()]))
    rows = moments.filter("at is not null").select("at", jobs.alias("j")).select("at", "j.*")
    return rows.groupBy("job", slot(F.unix_seconds(F.col("at").cast("timestamp")), F.col("minutes")).alias("slot")).agg(F.min("at").alias("at")).select("job", "at")


def tick(store: Store, jobs: list[Job], at: int) -> dict[str, str]:
    """Runs what is due at ``at`` (seconds since the epoch); returns what became of each job that ran."""
    spark = store.spark
    last = {r["job"]: r["at"] for r in store.read("kept_ticks").filter("at is not null").collect()}  # a row a job
    found = {}
    for job in jobs:
        if job.name in last and at // (job.minutes * 60) <= last[job.name] // (job.minutes * 60):
            continue
        try:
            job.run(F.timestamp_seconds(F.lit(at)))
            found[job.name] = (at, None)
        except Exception as error:  # noqa: BLE001 - kept with the job, which stays due
            found[job.name] = (last.get(job.name), str(error)[:500] or type(error).__name__)
    if found:
        rows = [(name, moment, error) for name, (moment, error) in found.items()]
        store.change("kept_ticks", spark.createDataFrame(rows, "job string, at bigint, error string"))
    return {name: "done" if error is None else f"failed: {error}" for name, (_, error) in found.items()}


def ticking(store: Store, jobs: list[Job], checkpoint: str, every: str = "1 minute", source: DataFrame | None = None, on_tick: Callable[[int, dict], None] | None = None):
    """Starts a query that ticks ``every`` so often; ``source`` (timestamp) tells the moments in place of the clock."""

    def each(batch: DataFrame, number: int) -> None:
        at = batch.agg(F.max(F.unix_seconds("timestamp"))).first()[0]
        if at is not None:
            outcomes = tick(store, jobs, at)
            if on_tick:
                on_tick(at, outcomes)

    clock = store.spark.readStream.format("rate").option("rowsPerSecond", 1).load() if source is None else source
    return clock.select("timestamp").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
