"""Raw rows to typed rows: one projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import scores, text, urls, values


def typed_events(raw: DataFrame) -> DataFrame:
    """Event rows of known root codes and well-formed dates, with relevance and source URL beside them.

    Keeps columns that aren't raw fields, so that a sequence number may ride along.
    """
    col = F.col
    quad = values.number(col("quad_class"))
    keep = [c for c in raw.columns if c in ("seq",)]
    # In a projection of its own: a lambda would take "actor1_code" for the column made below, not the raw one.
    raw = raw.withColumn("relevant", scores.relevant(col("actor1_code"), col("actor2_code"), col("actor1_country"), col("actor2_country")))
    rows = raw.select(
        *keep,
        F.concat(F.lit("gdelt-"), col("global_event_id")).alias("id"),
        col("global_event_id").alias("gdelt_event_id"),
        values.present(col("event_code")).alias("cameo_code"),
        values.present(col("event_root_code")).alias("cameo_root"),
        F.when(quad.isin(1.0, 2.0, 3.0, 4.0), quad.cast("int")).alias("quad_class"),
        values.number(col("goldstein")).alias("goldstein"),
        F.coalesce(values.present(col("actor1_country")), values.present(col("actor1_code"))).alias("actor1_code"),
        values.present(col("actor1_name")).alias("actor1_name"),
        F.coalesce(values.present(col("actor2_country")), values.present(col("actor2_code"))).alias("actor2_code"),
        values.present(col("actor2_name")).alias("actor2_name"),
        values.number(col("lat")).alias("lat"),
        values.number(col("lon")).alias("lon"),
        values.present(col("geo_name")).alias("geo_name"),
        scores.iso_country(col("geo_country")).alias("country_iso"),
        values.number(col("geo_type")).cast("int").alias("geo_precision"),
        values.moment(values.day_iso(col("sql_date"))).alias("occurred_at"),
        values.moment(values.moment_iso(col("date_added"))).alias("first_seen_at"),
        values.count(col("num_mentions")).alias("num_mentions"),
        values.count(col("num_sources")).alias("num_sources"),
        values.count(col("num_articles")).alias("num_articles"),
        values.number(col("avg_tone")).alias("avg_tone"),
        scores.root_category(col("event_root_code")).alias("category"),
        col("source_url"),
        "relevant",
    )
    return rows.filter("category is not null and occurred_at is not null and first_seen_at is not null")


def typed_articles(raw: DataFrame, fetched_at, source: str = "gdelt") -> DataFrame:
    """Article rows of the article search; rows without address or title go."""
    col = F.col
    known = F.create_map(*[F.lit(x) for pair in C.PUBLISHERS.items() for x in pair])
    rows = raw.filter((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    domain = F.lower("domain")
    return rows.select(
        F.concat(F.lit("art-"), urls.url_hash(col("url"))).alias("id"), F.lit(source).alias("source_id"), urls.canonical_url(col("url")).alias("url_canonical"), urls.url_hash(col("url")).alias("url_hash"),
        col("title"), text.title_key(col("title")).alias("title_norm"), text.simhash_hex(text.title_simhash(col("title")), padded=False).alias("title_simhash"), F.lit(None).cast("string").alias("excerpt"),
        values.moment(values.seen_iso(col("seendate"))).alias("published_at"), F.lit(fetched_at).cast("timestamp").alias("fetched_at"), values.present(col("language")).alias("lang"), F.lit(None).cast("string").alias("country_iso"),
        F.lit(None).cast("string").alias("dedup_group_id"), domain.alias("publisher_domain"), F.try_element_at(known, domain).alias("publisher_name"),
    )


def with_severity(events: DataFrame) -> DataFrame:
    return events.withColumn("severity", scores.severity(F.col("goldstein"), F.col("cameo_root"), F.col("quad_class")))
