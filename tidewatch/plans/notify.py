"""Alert and watch ticks: what is due is one plan, sent by partition, recorded from the tasks' receipts.

A tick's rows lie in an outbox folder of the store before any is sent, and receipts
beside them.  What a tick sent is recorded by itself or, if it was cut off, by the
next one, which does so first; then it sends what is still due.  A push can so be
repeated, within one open group of a task, but not lost, and none is recorded twice.
"""

from __future__ import annotations

import json
import uuid
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators.alerts import current_values, due_alerts, watch_impacts
from ..operators.graph import ready
from ..sources import files, push
from ..sources.push import DEAD, GROUP, PAUSE_SECONDS, RETRIES, SendError, send  # noqa: F401
from ..sources.store import Store, absent

WATCH_KEY = ("device_id", "kind", "symbol", "exchange", "situation_id")


class Sender(Protocol):
    """Pickled into the tasks; raises ``SendError`` for what the service refuses."""

    def send(self, token: str, payload: dict) -> None: ...


def _outbox(store: Store, kind: str) -> str:
    """The store's outbox, with its scheme, so that tasks see the same place as Spark does."""
    make = store.spark._jvm.org.apache.hadoop.fs.Path
    path = make(f"{store.root}/_outbox/{kind}")
    return path.getFileSystem(store.spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()


def _receipts(store: Store, folder: str) -> DataFrame:
    """(key, outcome), one a key: a push that went through counts whatever else was tried."""
    schema = "key string, outcome string"
    if not files.listed(f"{folder}/receipts", "p"):
        return store.spark.createDataFrame([], schema)
    rows = store.spark.read.schema(schema).option("pathGlobFilter", "p*.json").json(f"{folder}/receipts")
    return rows.groupBy("key").agg(F.max("outcome").alias("outcome"))  # "sent" is the greatest


def _open(store: Store, kind: str) -> list[str]:
    """Outboxes of ticks that were cut off before their receipts were recorded."""
    fs, root = files.opened(_outbox(store, kind))
    found = fs.get_file_info(files.fs.FileSelector(root, allow_not_found=True))
    names = sorted(x.base_name for x in found if x.type == files.fs.FileType.Directory)
    return [f"{_outbox(store, kind)}/{name}" for name in names if not files.exists(f"{_outbox(store, kind)}/{name}/recorded.json") and files.exists(f"{_outbox(store, kind)}/{name}/ready.json")]


def _tick(store: Store, kind: str, due, record, sender: Sender, pause: float) -> int:
    """Records what earlier ticks left, sends what is due (key, device, token, payload and what ``record`` needs), records it; returns how many were sent."""
    spark = store.spark
    for folder in _open(store, kind):
        _record(store, folder, record)
    folder = f"{_outbox(store, kind)}/{uuid.uuid4().hex}"
    rows = due()
    rows.repartition("device").sortWithinPartitions("device", "nth").write.parquet(f"{folder}/due")
    files.put_text(f"{folder}/ready.json", "{}")
    spark.dataSource.register(push.sink(sender, folder, pause))
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/due")
    stored.select("key", "device", "token", "payload").write.format("push").mode("append").save()
    return _record(store, folder, record)


def _record(store: Store, folder: str, record) -> int:
    due, receipts = store.spark.read.parquet(f"{folder}/due"), _receipts(store, folder)
    tried = due.join(receipts, "key").checkpoint()
    outcomes = {r["outcome"]: r["n"] for r in tried.groupBy("outcome").agg(F.count("*").alias("n")).collect()}  # three numbers
    sent, gone = tried.filter(F.col("outcome") == push.SENT), tried.filter(F.col("outcome") == push.GONE)
    if outcomes.get(push.SENT):
        record(sent)
    if outcomes.get(push.GONE):
        # By token: a device that has registered anew since is alive.
        store.change("devices", gone=store.read("devices").join(gone.select(F.col("token").alias("apns_token")), "apns_token", "left_semi"))
    files.put_text(f"{folder}/recorded.json", json.dumps(outcomes))
    return outcomes.get(push.SENT, 0)


def alert_tick(store: Store, sender: Sender, now: Column, pause: float = PAUSE_SECONDS) -> int:
    """Sends due alerts; returns how many this tick sent."""
    ready(store.spark)

    def due() -> DataFrame:
        subjects = current_values(store.read("asset_prices"), store.read("situations"), store.read("outlook_markets"))
        rows = due_alerts(store.read("alerts"), store.read("devices"), subjects, store.read("alert_deliveries"), now)
        state = F.when(F.col("live_activity"), F.struct(F.lit("Triggered").alias("status"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updatedAt")))
        payload = F.to_json(F.struct(F.col("id").alias("alert"), F.col("subject_type").alias("subjectType"), F.col("subject_id").alias("subjectID"), F.col("current").alias("value"), state.alias("state")))
        return rows.select(F.col("id").alias("key"), F.col("device_id").alias("device"), F.col("apns_token").alias("token"), payload.alias("payload"), F.lit(0).alias("nth"), "payload_hash", now.alias("at"))

    def record(sent: DataFrame) -> None:
        rows = sent.select(F.col("key").alias("alert_id"), F.col("at").alias("fired_at"), "payload_hash")
        store.append("alert_deliveries", absent(store.read("alert_deliveries"), rows, ("alert_id", "fired_at")))
        marked = store.read("alerts").join(sent.select(F.col("key").alias("id"), F.col("at").alias("_sent")), "id")
        store.change("alerts", marked.withColumn("last_fired_at", F.col("_sent")))

    return _tick(store, "alerts", due, record, sender, pause)


def watch_tick(store: Store, sender: Sender, now: Column, most: int = C.MAX_PUSHES, pause: float = PAUSE_SECONDS) -> int:
    """Sends pushes for watched names that ranked situations may affect; unsent ones come again."""
    ready(store.spark)

    def due() -> DataFrame:
        rows = watch_impacts(store.read("device_watches"), store.read("devices"), store.read("situations"), store.read("watch_deliveries"), most)
        payload = F.to_json(F.struct(F.concat("name", F.lit(" may be affected")).alias("title"), F.col("title").alias("body"), F.col("situation_id").alias("situationID"), "kind", "symbol"))
        key = F.to_json(F.struct(*WATCH_KEY))
        return rows.select(key.alias("key"), F.col("device_id").alias("device"), F.col("apns_token").alias("token"), payload.alias("payload"), "nth", *WATCH_KEY, now.alias("delivered_at"))

    def record(sent: DataFrame) -> None:
        rows = sent.select(*WATCH_KEY, "delivered_at")
        store.append("watch_deliveries", absent(store.read("watch_deliveries"), rows, WATCH_KEY))

    return _tick(store, "watches", due, record, sender, pause)
