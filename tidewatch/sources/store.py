"""Versioned Parquet tables and keyed changes to them.

A table is the parts that a small pointer file names; it is moved into place last, so
readers see whole versions only, and a failed write leaves the old one.  A part holds
new rows, or changes: rows that take the place of those of their key, and rows that
are gone.  Changes are merged when read, so a batch or one device's change writes in
proportion to itself; once ``PARTS`` have gathered, one new part takes the place of all.

Some tables are laid out in folders, by a hash of whose rows they are (one device's
rows lie in one bucket) or by day (a range of time names its days).  What is too old
is left out by a date in the pointer, which costs no writing.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .schemas import KEPT, TABLES, Table


def insert_absent(old: DataFrame, new: DataFrame, *keys: tuple[str, ...]) -> DataFrame:
    """``old`` and those rows of ``new`` that clash with no old row on any of ``keys``, one a key.

    Rows of ``new`` that clash with each other: the least by all columns stays.
    """
    return old.unionByName(absent(old, new, *keys))


def absent(old: DataFrame, new: DataFrame, *keys: tuple[str, ...]) -> DataFrame:
    """Those rows of ``new`` that ``insert_absent`` would add."""
    fresh = new.select(*old.columns)
    for key in keys:
        fresh = fresh.groupBy(*key).agg(F.min(F.struct(*[c for c in old.columns])).alias("_r")).select("_r.*")
        fresh = fresh.join(old.select(*key), list(key), "left_anti").select(*old.columns)
    return fresh


def upsert(old: DataFrame, new: DataFrame, key: tuple[str, ...], changes: dict[str, Column] | None = None, keep: Column | None = None) -> DataFrame:
    """``old`` with rows of ``new`` put in or over those of the same key.

    In ``changes`` and ``keep`` the sides are aliased ``o`` and ``n``.  ``changes`` says what a
    column of a row on both sides becomes (the new value otherwise); where ``keep`` holds,
    the old row stays as it is.
    """
    changes = changes or {}
    o, n = old.alias("o"), new.select(*old.columns).withColumn("_new", F.lit(True)).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key])
    joined = o.withColumn("_old", F.lit(True)).alias("o").join(n, on, "full_outer")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    stays = F.col("_new").isNull() if keep is None else F.col("_new").isNull() | (both & F.coalesce(keep, F.lit(False)))
    return joined.select(*[F.when(stays, F.col(f"o.{c}")).when(both, changes.get(c, F.col(f"n.{c}"))).otherwise(F.col(f"n.{c}")).alias(c) for c in old.columns])


def update(rows: DataFrame, where: Column, **values: Column) -> DataFrame:
    return rows.withColumns({c: F.when(F.coalesce(where, F.lit(False)), v).otherwise(F.col(c)) for c, v in values.items()})


def upsert_markets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Forecast markets by venue and slug: the previous probability moves only when the current one changes.

    What a fetch doesn't carry (id, description, category, tags, hourly change) stays as it is.
    """
    moved = F.when(F.col("o.probability") != F.col("n.probability"), F.col("o.probability")).otherwise(F.col("o.prev_probability"))
    kept = {c: F.col(f"o.{c}") for c in ("id", "url", "description", "category", "tags", "outcome_label", "prob_change_1h")}
    return upsert(old, new, ("venue", "slug"), kept | {"prev_probability": moved})


def upsert_links(old: DataFrame, new: DataFrame) -> DataFrame:
    """Outlook links: a manual one is never written over."""
    kept = {c: F.col(f"o.{c}") for c in ("is_manually_verified", "method")}
    return upsert(old, new, ("situation_id", "market_id"), kept, keep=F.col("o.matched_by") == "manual")


#: Parts of a table beyond which they are put together.
PARTS = 64
BUCKETS = 16

#: Column by whose hash or day a table is laid out; a key's rows never move to another folder.
BY_HASH = {"devices": "id", "alerts": "device_id", "device_watches": "device_id", "watch_deliveries": "device_id", "alert_deliveries": "alert_id", "kept_keys": "situation_id", "kept_picks": "situation_id"}
BY_DAY = {"asset_prices": "ts", "score_history": "ts"}
FOLDER, PART = "in_folder", "part"


def folder_of(name: str, value: Column | None = None) -> Column | None:
    """The folder of a row, or of a value of the layout's column."""
    if name in BY_HASH:
        return F.pmod(F.xxhash64(F.col(BY_HASH[name]) if value is None else value), F.lit(BUCKETS)).cast("string")
    if name in BY_DAY:
        return F.date_format(F.col(BY_DAY[name]) if value is None else value, "yyyyMMdd")
    return None


def table_of(name: str) -> Table:
    return TABLES[name] if name in TABLES else KEPT[name]


class Store:
    """Tables below one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        ship(spark)
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_current.json"

    def version(self, name: str) -> dict:
        """The current version: parts in order, which of them are changes, and the time before which rows are left out."""
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path(self._pointer(name))
        if not fs.exists(path):
            return {"parts": [], "changes": [], "since": None}
        stream = fs.open(path)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str, of: object = None, since: Column | None = None) -> DataFrame:
        """The current version, or an empty table of the right schema.

        ``of``: only rows whose layout column has this value, from their bucket; ``since``:
        only rows from this time on, from their days.
        """
        now, schema = self.version(name), table_of(name).schema
        keep = []
        if of is not None:
            keep += [F.col(FOLDER) == folder_of(name, F.lit(of)), F.col(BY_HASH[name]) == of]
        for moment in (since, None if now["since"] is None else F.to_timestamp(F.lit(now["since"]))):
            if moment is not None:
                keep += [F.col(FOLDER) >= folder_of(name, moment), F.col(BY_DAY[name]) >= moment]
        base = self._rows(name, [p for p in now["parts"] if p not in now["changes"]], schema, keep)
        if not now["changes"]:
            return base.drop(FOLDER, PART)
        marked = T.StructType([*schema, T.StructField("gone", T.BooleanType())])
        # Changes that a filter leaves out concern rows that it leaves out: a key never leaves its folder.
        changes = self._rows(name, now["changes"], marked, keep)
        order = F.create_map(*[F.lit(x) for n, p in enumerate(now["changes"]) for x in (p, n)])
        key = list(table_of(name).key)
        last = changes.groupBy(*key).agg(F.max_by(F.struct("gone", *schema.names), order[F.col(PART)]).alias("_r")).select("_r.*")
        return base.drop(FOLDER, PART).join(last.select(*key), key, "left_anti").select(*schema.names).unionByName(last.filter(~F.col("gone")).select(*schema.names))

    def _rows(self, name: str, parts: list[str], schema, keep: list[Column]) -> DataFrame:
        full = T.StructType([*schema, *([T.StructField(FOLDER, T.StringType())] if folder_of(name) is not None else []), T.StructField(PART, T.StringType())])
        if not parts:
            rows = self.spark.createDataFrame([], full)
        else:
            rows = self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(*[f"{self.root}/{name}/{PART}={p}" for p in parts])
        return reduce(DataFrame.filter, keep, rows)

    def write(self, name: str, rows: DataFrame) -> None:
        """Makes ``rows`` the current version, with the table's columns and types; may read the current one."""
        self._point(name, {"parts": [self._part(name, rows)], "changes": [], "since": None})

    def append(self, name: str, rows: DataFrame) -> None:
        """Adds ``rows``, whose keys the table doesn't have; what is there is not written again."""
        now = self.version(name)
        if now["changes"]:  # one of them may say that a key of these rows is gone
            self.change(name, rows)
        else:
            self._add(name, now, self._part(name, rows), False)

    def change(self, name: str, rows: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Puts ``rows`` in or over those of their keys and takes ``gone`` (whole rows) out; nothing else is written."""
        names = table_of(name).schema.names
        both = [df.select(*names, F.lit(flag).alias("gone")) for df, flag in ((gone, True), (rows, False)) if df is not None]
        self._add(name, self.version(name), self._part(name, reduce(DataFrame.unionByName, both), changes=True), True)

    def drop_before(self, name: str, moment: str) -> None:
        """Rows of before ``moment`` (yyyy-MM-dd HH:mm:ss, as the session's zone has it) are gone from now on; writes the pointer alone."""
        now = self.version(name)
        if now["since"] is None or now["since"] < moment:
            self._point(name, now | {"since": moment})

    def _add(self, name: str, now: dict, part: str, changes: bool) -> None:
        self._point(name, now | {"parts": [*now["parts"], part], "changes": [*now["changes"], *([part] if changes else [])]})
        if len(now["parts"]) >= PARTS:
            self.write(name, self.read(name))

    def _part(self, name: str, rows: DataFrame, changes: bool = False) -> str:
        part, folder = f"v-{uuid.uuid4().hex}", folder_of(name)
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_of(name).schema], *(["gone"] if changes else []))
        path = f"{self.root}/{name}/{PART}={part}"
        if folder is None:
            typed.write.parquet(path)
        else:
            typed.withColumn(FOLDER, folder).hint("rebalance", F.col(FOLDER)).write.partitionBy(FOLDER).parquet(path)
        return part

    def _point(self, name: str, version: dict) -> None:
        jvm, fs = self._fs()
        make = jvm.org.apache.hadoop.fs.Path
        temporary = make(f"{self.root}/{name}/_next-{uuid.uuid4().hex}.json")
        out = fs.create(temporary, True)
        out.write(json.dumps(version).encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri() if temporary.isAbsolute() and temporary.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(temporary, make(self._pointer(name)), options)

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Removes all parts but those of the current version and the ``keep - 1`` newest others; returns how many went."""
        jvm, fs = self._fs()
        current = self.version(name)["parts"]
        found = [s for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")) if s.isDirectory() and s.getPath().getName().startswith(f"{PART}=")]
        others = sorted((s for s in found if s.getPath().getName()[len(PART) + 1 :] not in current), key=lambda s: -s.getModificationTime())
        for s in others[keep - 1 :]:
            fs.delete(s.getPath(), True)
        return max(0, len(others) - keep + 1)


def seed(store: Store, name: str, rows: DataFrame) -> None:
    """Puts register rows in or over those of the same id."""
    schema = TABLES[name].schema
    have = {c.lower() for c in rows.columns}
    defaults = {"fail_count": F.lit(0), "delay_minutes": F.lit(0), "excerpt_allowed": F.lit(False), "is_active": F.lit(True), "is_delayed": F.lit(False)}
    full = rows.select(*[(F.col(f.name) if f.name.lower() in have else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schema])
    store.write(name, upsert(store.read(name), full, TABLES[name].key))
