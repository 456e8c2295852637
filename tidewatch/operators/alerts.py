"""Alert rules, cooldowns, deliveries."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as C
from .fold import numbered
from .graph import ready, saved
from .links import asset_links, company_links


def triggered(operator: Column, threshold: Column, current: Column, previous: Column) -> Column:
    """A crossing needs a previous value strictly on one side and a current one at or past the threshold."""
    crosses = ((previous < threshold) & (current >= threshold)) | ((previous > threshold) & (current <= threshold))
    return (
        F.when(operator == "gt", current > threshold).when(operator == "gte", current >= threshold).when(operator == "lt", current < threshold)
        .when(operator == "lte", current <= threshold).when(operator == "crosses", F.coalesce(crosses, F.lit(False))).otherwise(F.lit(False))
    )


def reason(active: Column, fires: Column, last_fired: Column, now: Column, cooldown_minutes: Column) -> Column:
    """inactive, below_threshold, cooldown or triggered."""
    elapsed = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last_fired.cast("timestamp"))) / 6e7
    return F.when(~active, "inactive").when(~F.coalesce(fires, F.lit(False)), "below_threshold").when(F.coalesce(elapsed < cooldown_minutes, F.lit(False)), "cooldown").otherwise("triggered")


def fifteen_digits(value: Column) -> Column:
    """Fifteen significant digits with their zeros, rounded from the number itself, small values without an exponent too.

    The built-in formats round the shortest decimal text that reads back as the number, so one that
    ends in a sixteenth digit of five goes up although the number lies below the middle.
    """

    def said(x: float | None) -> str | None:
        if x is None:
            return None
        if not math.isfinite(x):
            return "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"
        x = x or 0.0  # no sign of zero
        short = f"{x:.14e}"
        exponent = int(short.split("e")[1])
        return short if exponent > 14 else f"{x:.{14 - exponent}f}"

    return F.udf(said, "string", useArrow=True)(value.cast("double"))


def delivery_key(alert_id: Column, fired_at: Column, value: Column) -> Column:
    """Digest of alert, time and value at fifteen significant digits."""
    return F.sha2(F.concat_ws("|", alert_id, fired_at, fifteen_digits(value)).cast("binary"), 256)


def current_values(prices: DataFrame, situations: DataFrame, markets: DataFrame) -> DataFrame:
    """(subject_type, subject_id, current, previous) of every subject that an alert may name."""
    two = prices.withColumn("rn", F.row_number().over(W.partitionBy("asset_id").orderBy(F.desc("ts")))).filter("rn <= 2")
    assets = two.groupBy("asset_id").agg(F.max(F.when(F.col("rn") == 1, F.col("price"))).alias("current"), F.max(F.when(F.col("rn") == 2, F.col("price"))).alias("previous"))
    null = F.lit(None).cast("double")
    return (
        assets.select(F.lit("asset").alias("subject_type"), F.col("asset_id").alias("subject_id"), "current", "previous")
        .unionByName(situations.select(F.lit("situation").alias("subject_type"), F.col("id").alias("subject_id"), F.col("trending_score").alias("current"), null.alias("previous")))
        .unionByName(markets.filter("not is_resolved").select(F.lit("market").alias("subject_type"), F.col("id").alias("subject_id"), F.col("probability").alias("current"), F.col("prev_probability").alias("previous")))
    )


def due_alerts(alerts: DataFrame, devices: DataFrame, subjects: DataFrame, deliveries: DataFrame, now: Column) -> DataFrame:
    """Active alerts that fire now and were not delivered with this very value: one plan for all of them."""
    rows = alerts.filter("is_active").join(devices.select(F.col("id").alias("device_id"), "apns_token"), "device_id").join(subjects, ["subject_type", "subject_id"])
    why = reason(F.col("is_active"), triggered(F.col("operator"), F.col("threshold"), F.col("current"), F.col("previous")), F.col("last_fired_at"), now, F.col("cooldown_minutes"))
    fired = rows.filter(why == "triggered").withColumn("payload_hash", delivery_key(F.col("id"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.col("current")))
    return fired.join(deliveries.select(F.col("alert_id").alias("id"), "payload_hash"), ["id", "payload_hash"], "left_anti")


def fired_series(observations: DataFrame, minutes: int) -> DataFrame:
    """(key, at, fired): which triggered observations fire if each firing starts a cooldown.

    Whether one fires depends on the last that did, so this is a fold in time order per key.
    A key's rows stream through in batches; only the time of the last firing is kept.
    Observations: key, at (timestamp), rn (order), fires (boolean).
    """

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict = {"key": None, "at": None}
        for frame in frames:
            fired = []
            for key, at, fires in zip(frame["key"], frame["at"], frame["fires"], strict=True):
                if key != last["key"]:
                    last = {"key": key, "at": None}
                yes = bool(fires) and (last["at"] is None or (at - last["at"]).total_seconds() >= minutes * 60)
                last["at"] = at if yes else last["at"]
                fired.append(yes)
            yield pd.DataFrame({"key": frame["key"], "at": frame["at"], "rn": frame["rn"], "fired": fired})

    ordered = observations.select("key", "at", "rn", "fires").repartition("key").sortWithinPartitions("key", "rn")
    kinds = {f.name: f.dataType.simpleString() for f in observations.schema}
    return ordered.mapInPandas(fold, f"key {kinds['key']}, at {kinds['at']}, rn {kinds['rn']}, fired boolean")


#: Rows that stand together when the first hits of watches are looked up: bounds a group, whatever a target's share.
BLOCK = 4096


def _smallest(rows: DataFrame, k: int) -> DataFrame:
    """(group, at, ids) of rows that ask: the ``k`` smallest ids of the rows before each in its group.

    rows: group, at, ids (sorted array or null), asks; one that asks and brings ids asks first.
    A group's rows stream by in order, with ``k`` ids in memory.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, best = None, []
        for batch in batches:
            out = []
            for g, at, ids, asks in zip(*(batch[c].to_pylist() for c in ("group", "at", "ids", "asks")), strict=True):
                if g != group:
                    group, best = g, []
                if asks:
                    out.append((g, at, best))
                if ids and (len(best) < k or ids[0] < best[-1]):
                    best = sorted(best + ids)[:k]
            types = (pa.string(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["group", "at", "ids"])

    return rows.repartition("group").sortWithinPartitions("group", "at").mapInArrow(scan, "group string, at long, ids array<string>")


def _first_hits(line: DataFrame, k: int) -> DataFrame:
    """(nth, ids) of the questions of ``line``: the ``k`` smallest ids of their target's hits before them.

    line: nth (place from 0 on, a target's rows together), target, id (null: a question).  Blocks of
    bounded size are summed up by their ``k`` smallest ids; what the blocks before one hold is carried
    into it, so no task gets all rows of a target, only its blocks' sums.
    """
    line = line.withColumn("block", F.floor(F.col("nth") / BLOCK))
    nth = F.row_number().over(W.partitionBy("block", "target").orderBy(F.asc_nulls_last("id")))
    ends = line.withColumn("_n", nth).filter(F.col("_n") <= k).groupBy("target", "block").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    carried = _smallest(ends.select(F.col("target").alias("group"), F.col("block").alias("at"), "ids", F.lit(True).alias("asks")), k)
    group = F.concat_ws("|", "block", "target").alias("group")
    inside = line.select(group, F.col("nth").alias("at"), F.when(F.col("id").isNotNull(), F.array("id")).alias("ids"), F.col("id").isNull().alias("asks"))
    ahead = carried.select(F.concat_ws("|", "at", "group").alias("group"), F.lit(-1).cast("long").alias("at"), "ids", F.lit(False).alias("asks"))
    return _smallest(inside.unionByName(ahead), k).select(F.col("at").alias("nth"), "ids")


def _fresh(watches: DataFrame, hits: DataFrame, sent: Callable[[DataFrame], DataFrame], most: int) -> DataFrame:
    """(device_id, kind, symbol, exchange, situation_id): the first ``most`` unsent hits of each watch at least, in the order of their ids.

    Watches never meet all hits of their target: each takes its first few, and only those that had too
    many of them sent already come again for four times as many.
    """
    target, own = F.to_json(F.array("kind", "symbol", "exchange")).alias("target"), ["device_id", "kind", "symbol", "exchange"]
    todo = saved(watches.filter("kind is not null and symbol is not null and exchange is not null and created_at is not null").select(*own, target, F.col("created_at").alias("at")))
    new = hits.filter("first_seen_at is not null").select(target, F.col("first_seen_at").alias("at"), "id")
    asked = todo.select("target", "at").distinct().withColumn("id", F.lit(None).cast("string"))
    line = saved(numbered(new.unionByName(asked), "target", F.desc("at"), F.col("id").isNull()))
    k, out = 2 * most, []
    while True:
        places = line.filter("id is null").join(todo.select("target", "at").distinct(), ["target", "at"], "left_semi")
        found = saved(_first_hits(line.filter("id is not null").unionByName(places), k).join(places.select("nth", "target", "at"), "nth").select("target", "at", "ids"))
        pairs = todo.join(found, ["target", "at"]).select(*own, (F.size("ids") == k).alias("more"), F.explode("ids").alias("situation_id"))
        fresh = saved(sent(pairs))
        enough = fresh.groupBy(*own).agg(F.count("*").alias("n")).filter(F.col("n") >= most)
        short = saved(todo.join(found.filter(F.size("ids") == k), ["target", "at"]).join(enough, own, "left_anti").select(todo.columns))
        out.append(fresh.drop("more"))
        if short.isEmpty():
            return reduce(DataFrame.unionByName, out)
        out[-1] = out[-1].join(short, own, "left_anti")
        todo, k = short, 4 * k


def watch_impacts(watches: DataFrame, devices: DataFrame, situations: DataFrame, delivered: DataFrame | Callable[[DataFrame], DataFrame], most: int = C.MAX_PUSHES) -> DataFrame:
    """Pushes to send: watched names that visible situations link to, not older than the watch, not yet sent.

    At most ``most`` a device and run; the rest stay unsent and come with a later run.  ``delivered``
    is the table of what was sent, or leaves the unsent ones of (device_id, kind, symbol, exchange, situation_id).
    """
    ready(watches.sparkSession)
    shown = situations.filter("status = 'active' and map_rank is not null")
    named = company_links(shown, C.COMPANY_LIMIT_WATCH).select("id", F.lit("company").alias("kind"), "symbol", "exchange")
    named = named.unionByName(asset_links(shown).select("id", F.lit("asset").alias("kind"), "symbol", F.lit("").alias("exchange")))
    hits = named.join(shown.select("id", "first_seen_at"), "id")
    own = ["device_id", "kind", "symbol", "exchange"]
    known = devices.select(F.col("id").alias("device_id"), "apns_token")
    sent = delivered if callable(delivered) else lambda pairs: pairs.join(delivered.select(*own, "situation_id"), [*own, "situation_id"], "left_anti")
    fresh = _fresh(watches.join(known.select("device_id"), "device_id", "left_semi"), hits, sent, most)
    nth = F.row_number().over(W.partitionBy("device_id").orderBy("situation_id", "kind", "symbol", "exchange"))
    few = fresh.withColumn("nth", nth).filter(F.col("nth") <= most)
    names = F.create_map(*[F.lit(x) for s, v in C.COMPANIES.items() for x in (f"company|{s}", v[0])], *[F.lit(x) for s, v in C.WATCHABLE_ASSETS.items() for x in (f"asset|{s}", v)])
    titles = shown.select(F.col("id").alias("situation_id"), "title", "first_seen_at")
    return few.join(known, "device_id").join(titles, "situation_id").withColumn("name", names[F.concat_ws("|", "kind", "symbol")])


def known_targets(watches: DataFrame) -> Column:
    """True for a watch of a listed company at its exchange, or of a watchable asset without one."""
    company = F.concat_ws("|", "symbol", "exchange").isin(*[f"{s}|{v[1]}" for s, v in C.COMPANIES.items()])
    asset = F.col("symbol").isin(*C.WATCHABLE_ASSETS) & (F.col("exchange") == "")
    return F.when(F.col("kind") == "company", company).when(F.col("kind") == "asset", asset).otherwise(F.lit(False))
