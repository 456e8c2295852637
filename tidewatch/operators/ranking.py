"""Lifecycle, decay and capped ranks of situations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import scores
from .cluster import visible


def aged(situations: DataFrame, now: Column) -> DataFrame:
    """Active ones idle for too long become recent, recent ones archived; both may happen at once."""
    idle = lambda hours: F.col("last_event_at") < now - F.make_dt_interval(hours=F.lit(hours))
    recent = F.when((F.col("status") == "active") & idle(C.ACTIVE_HOURS), "recent").otherwise(F.col("status"))
    status = F.when((recent == "recent") & idle(24 * C.ARCHIVE_DAYS), "archived").otherwise(recent)
    rank = F.when(status == F.col("status"), F.col("map_rank"))
    return situations.withColumns({"status": status, "map_rank": rank})


def capped(rows: DataFrame, score: str, key: str, group: str, per_group: int = C.PER_COUNTRY, top: int = C.TOP_N) -> DataFrame:
    """The ``top`` rows by score, at most ``per_group`` of a group, with their ``rank``; null groups stand alone.

    A row is passed over only if enough better rows of its group were taken, so the cap and
    then the limit give what going down the list would.  Only ``per_group`` rows of each
    group, and of those only ``top``, reach the last window, which has no partition.
    """
    order = [F.desc(score), F.col(key).asc()]
    own = F.coalesce(F.col(group).cast("string"), F.concat(F.lit("unknown-"), F.col(key).cast("string")))
    within = rows.withColumn("_nth", F.row_number().over(W.partitionBy(own).orderBy(*order))).filter(F.col("_nth") <= per_group).drop("_nth")
    few = within.orderBy(*order).limit(top)
    return few.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def ranked(situations: DataFrame, now: Column) -> DataFrame:
    """Situations after a ranking tick: aged; visible active ones decayed to now and ranked anew, the rest as they were."""
    rows = aged(situations, now)
    shown = (F.col("status") == "active") & visible(F.col("source_count"))
    score = scores.decayed(F.col("trending_score"), F.coalesce("score_updated_at", "last_event_at"), now, F.col("category"))
    top = capped(rows.filter(shown).select("id", "country_iso", score.alias("score")), "score", "id", "country_iso").select("id", F.col("rank").alias("_rank"))
    joined = rows.join(F.broadcast(top), "id", "left")  # TOP_N rows
    return joined.select(
        *[c for c in situations.columns if c not in ("trending_score", "score_updated_at", "map_rank")],
        F.when(shown, score).otherwise(F.col("trending_score")).alias("trending_score"),
        F.when(shown, now).otherwise(F.col("score_updated_at")).alias("score_updated_at"),
        F.when(shown, F.col("_rank")).otherwise(F.col("map_rank")).alias("map_rank"),
    ).select(*situations.columns)


def decayed_sum(impulses: DataFrame, key: str, category: str, at: str, magnitude: str, now: Column) -> DataFrame:
    """(key, score, n): each key's impulses, each decayed from its time to now, and how many.

    Equal to folding them in time order, but associative, so partial sums are made before
    the shuffle.  Arrivals after ``now`` count in full.
    """
    from ..functions.values import hours_between

    part = F.greatest(F.col(magnitude), F.lit(0.0)) * scores.decay_factor(F.col(category), hours_between(F.col(at), now))
    return impulses.groupBy(key).agg(F.sum(part).alias("score"), F.count("*").alias("n"))
