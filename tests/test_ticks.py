"""Ticks: what is due, what is tried again, and a stream of simulated minutes."""

import time
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tests.test_catalogue import SF
from tidewatch.plans import stored
from tidewatch.sources.store import Store
from tidewatch.streaming import ticks

START = int(datetime(2024, 2, 1, 9, 53, tzinfo=timezone.utc).timestamp())


def moment(now, spark):
    return spark.range(1).select(F.unix_seconds(now)).first()[0]


def test_twelve_minutes(spark, tmp_path):
    store, ran, seen = Store(spark, str(tmp_path / "store")), [], []
    jobs = [ticks.Job(name, minutes, lambda now, name=name: ran.append((name, moment(now, spark)))) for name, minutes in ticks.PERIODS.items()]
    clock = spark.readStream.format("rate-micro-batch").options(rowsPerBatch="1", numPartitions="1", startTimestamp=str(START * 1000), advanceMillisPerBatch="60000").load()
    stream = ticks.ticking(store, jobs, str(tmp_path / "ck"), "0 seconds", clock, lambda at, outcomes: seen.append(at))
    until = time.time() + 120
    while len(seen) < 12 and stream.isActive and time.time() < until:
        time.sleep(0.2)
    stream.stop()
    first = [s for s in seen if s < START + 12 * 60]
    assert first == [START + 60 * k for k in range(12)]  # 9:53 to 10:04
    minutes = {name: [(at - START) // 60 for n, at in ran if n == name and at < START + 12 * 60] for name in ticks.PERIODS}
    assert minutes == {"alerts": [0, 2, 7], "watches": [0, 2, 7], "ranking": [0, 7], "retention": [0, 7]}
    # The plan over all moments says the same.
    moments = spark.createDataFrame([(datetime.fromtimestamp(s, timezone.utc),) for s in first] + [(None,)], "at timestamp")
    planned = ticks.due_ticks(moments).select("job", F.unix_seconds("at").alias("at")).collect()
    assert sorted((r["job"], r["at"]) for r in planned) == sorted(x for x in ran if x[1] < START + 12 * 60)


def test_failures_and_restarts(spark, tmp_path):
    store, ran, broken = Store(spark, str(tmp_path)), [], [True]

    def work(now):
        if broken[0]:
            raise ValueError("no source")
        ran.append(moment(now, spark))

    jobs = [ticks.Job("quotes", 5, work), ticks.Job("ranking", 15, lambda now: ran.append("ranked"))]
    assert ticks.tick(store, jobs, START) == {"quotes": "failed: no source", "ranking": "done"} and ran == ["ranked"]
    broken[0] = False
    assert ticks.tick(store, jobs, START + 60) == {"quotes": "done"}  # tried again by the next tick
    assert ticks.tick(Store(spark, str(tmp_path)), jobs, START + 60) == {}  # the same tick once more, after a restart
    assert ticks.tick(store, jobs, START + 40 * 60) == {"quotes": "done", "ranking": "done"}  # slots passed over run once
    rows = {r["job"]: (r["at"], r["error"]) for r in store.read("kept_ticks").collect()}
    assert rows == {"quotes": (START + 40 * 60, None), "ranking": (START + 40 * 60, None)}
    assert ticks.tick(store, [], START) == {} and ran[1:] == [START + 60, START + 40 * 60, "ranked"]


def test_standard_jobs(spark):
    names = ("situations", "devices", "device_watches", "watch_deliveries", "alerts", "asset_prices", "outlook_markets")
    store = stored.filled(spark, SF, *names)
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    jobs = ticks.standard(store, stored.Box(), 0)
    found = ticks.tick(store, jobs, int(at.timestamp()))
    assert found == dict.fromkeys(ticks.PERIODS, "done")
    first = {r["alert_id"] for r in store.read("alert_deliveries").collect()}
    assert first and store.version("asset_prices")["since"] == "2024-01-02 00:00:00"
    assert set(ticks.tick(store, jobs, int(at.timestamp()) + 300)) == {"alerts", "watches"}
    sent = [r["alert_id"] for r in store.read("alert_deliveries").collect()]
    assert len(sent) == len(set(sent)) and set(sent) > first  # those of the first tick rest, others are due by now
