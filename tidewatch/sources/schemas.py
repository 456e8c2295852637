"""Table schemas, keys and value rules, and their validation.

Parquet enforces none of these, so ``violations`` says which rows break what.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import CATEGORIES


@dataclass(frozen=True)
class Table:
    """Columns as DDL, the key, further unique column sets, allowed values and ranges."""

    ddl: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    values: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(self.ddl)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


_LICENSE = ("green", "amber", "red")
TABLES = {
    "sources": Table(
        "id string not null, name string not null, domain string not null, feed_url string, kind string not null, credibility_tier int not null, license_class string not null, excerpt_allowed boolean not null, attribution_text string, attribution_url string, terms_url string, terms_reviewed_at string, is_active boolean not null, etag string, last_modified string, last_ok_at timestamp, fail_count bigint not null",
        ("id",), values={"kind": ("rss", "gdelt", "api", "government"), "license_class": _LICENSE}, ranges={"credibility_tier": (1, 4)},
    ),
    "articles": Table(
        "id string not null, source_id string not null, url_canonical string not null, url_hash string not null, title string not null, title_norm string not null, title_simhash string not null, excerpt string, published_at timestamp, fetched_at timestamp not null, lang string, country_iso string, dedup_group_id string, publisher_domain string, publisher_name string",
        ("id",), (("url_canonical",),), parents={"source_id": "sources"},
    ),
    "events": Table(
        "id string not null, gdelt_event_id string, cameo_code string, cameo_root string, quad_class int, goldstein double, actor1_code string, actor1_name string, actor2_code string, actor2_name string, lat double, lon double, geo_name string, country_iso string, geo_precision int, occurred_at timestamp not null, first_seen_at timestamp not null, num_mentions bigint not null, num_sources bigint not null, num_articles bigint not null, avg_tone double, category string not null",
        ("id",), (("gdelt_event_id",),), {"category": CATEGORIES}, {"quad_class": (1, 4)},
    ),
    "event_articles": Table("event_id string not null, article_id string not null", ("event_id", "article_id"), parents={"event_id": "events", "article_id": "articles"}),
    "entities": Table("id string not null, type string not null, canonical_name string not null, wikidata_id string, country_iso string, aliases array<string> not null", ("id",), values={"type": ("country", "org", "person", "place", "asset")}),
    "situations": Table(
        "id string not null, slug string not null, title string not null, headline_article_id string, category string not null, lat double not null, lon double not null, geo_name string, country_iso string, bbox_json string, status string not null, first_seen_at timestamp not null, last_event_at timestamp not null, trending_score double not null, score_updated_at timestamp, peak_score double not null, event_count bigint not null, source_count bigint not null, map_rank int",
        ("id",), (("slug",),), {"category": CATEGORIES, "status": ("active", "recent", "archived")}, parents={"headline_article_id": "articles"},
    ),
    "situation_events": Table("situation_id string not null, event_id string not null, joined_at timestamp not null, similarity double", ("situation_id", "event_id"), parents={"situation_id": "situations", "event_id": "events"}),
    "situation_entities": Table("situation_id string not null, entity_id string not null, weight double not null", ("situation_id", "entity_id"), parents={"situation_id": "situations", "entity_id": "entities"}),
    "assets": Table(
        "id string not null, symbol string not null, name string not null, class string not null, exchange string, currency string not null, country_iso string, data_source string not null, license_class string not null, is_delayed boolean not null, delay_minutes int not null",
        ("id",), (("symbol", "class"),), {"class": ("equity", "index", "fx", "crypto", "commodity", "bond"), "license_class": _LICENSE},
    ),
    "asset_prices": Table(
        "asset_id string not null, ts timestamp not null, price double not null, change_pct double, as_of timestamp not null, session_state string not null",
        ("asset_id", "ts"), values={"session_state": ("open", "closed", "preMarket", "postMarket", "continuous")}, parents={"asset_id": "assets"},
    ),
    "situation_assets": Table(
        "situation_id string not null, asset_id string not null, relation_type string not null, weight double not null, rationale_key string not null, source string not null",
        ("situation_id", "asset_id", "relation_type"), values={"relation_type": ("geographic", "sector", "supply_chain", "commodity")}, parents={"situation_id": "situations", "asset_id": "assets"},
    ),
    "outlook_markets": Table(
        "id string not null, venue string not null, slug string not null, url string, question string not null, question_normalised string not null, description string, category string, tags array<string> not null, end_date string, volume double, liquidity double, outcome_label string, probability double not null, prev_probability double, prob_change_1h double, prob_change_24h double, updated_at timestamp not null, is_resolved boolean not null",
        ("id",), (("venue", "slug"),), ranges={"probability": (0, 1)},
    ),
    "situation_outlook": Table(
        "situation_id string not null, market_id string not null, confidence double not null, matched_by string not null, is_manually_verified boolean not null, method string not null",
        ("situation_id", "market_id"), values={"matched_by": ("entity", "category", "manual", "token")}, ranges={"confidence": (0, 1)}, parents={"situation_id": "situations", "market_id": "outlook_markets"},
    ),
    "score_history": Table("situation_id string not null, ts timestamp not null, score double not null, components_json string not null", ("situation_id", "ts"), parents={"situation_id": "situations"}),
    "devices": Table("id string not null, apns_token string not null, region_iso string, is_pro boolean not null, created_at timestamp not null, last_seen_at timestamp not null", ("id",), (("apns_token",),)),
    "alerts": Table(
        "id string not null, device_id string not null, kind string not null, subject_type string not null, subject_id string not null, operator string not null, threshold double not null, window_minutes int, combinator_group_id string, live_activity boolean not null, is_active boolean not null, last_fired_at timestamp, cooldown_minutes int not null",
        ("id",), values={"kind": ("price", "percent", "velocity", "situation", "outlook"), "subject_type": ("asset", "situation", "market"), "operator": ("gt", "gte", "lt", "lte", "crosses")}, parents={"device_id": "devices"},
    ),
    "alert_deliveries": Table("alert_id string not null, fired_at timestamp not null, payload_hash string not null", ("alert_id", "fired_at"), parents={"alert_id": "alerts"}),
    "ingest_runs": Table(
        "id string not null, started_at timestamp not null, finished_at timestamp, stage string not null, status string not null, counts_json string, error string",
        ("id",), values={"stage": ("fetch", "normalize", "dedupe", "cluster", "score", "link", "emit", "lifecycle", "calibrate"), "status": ("running", "success", "failed")},
    ),
    "outlook_controls": Table("region_iso string not null, is_enabled boolean not null, reason string, updated_at timestamp not null", ("region_iso",)),
    "device_watches": Table("device_id string not null, kind string not null, symbol string not null, exchange string not null, created_at timestamp not null", ("device_id", "kind", "symbol", "exchange"), values={"kind": ("company", "asset")}, parents={"device_id": "devices"}),
    "watch_deliveries": Table("device_id string not null, kind string not null, symbol string not null, exchange string not null, situation_id string not null, delivered_at timestamp not null", ("device_id", "kind", "symbol", "exchange", "situation_id"), parents={"device_id": "devices"}),
}

#: Views that the engine keeps of the tables above, stored like them.
KEPT = {
    "kept_ticks": Table("job string not null, at bigint, error string", ("job",)),
    "kept_keys": Table("situation_id string not null, kind string not null, value string not null", ("situation_id", "kind", "value")),
    "kept_picks": Table(
        "situation_id string not null, headline struct<m: bigint, t: bigint, event_id: string, article_id: string, title: string>, place struct<m: bigint, first_seen_at: timestamp, event_id: string, lat: double, lon: double, geo_name: string, country_iso: string>",
        ("situation_id",),
    ),
}


def row_faults(name: str) -> Column:
    """Names of the rules that a row breaks, on its own."""
    table = TABLES[name]
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in table.required]
    checks += [F.when(~F.col(c).isin(*vs), F.lit(f"{c} is not allowed")) for c, vs in table.values.items()]
    checks += [F.when(~F.col(c).between(*r), F.lit(f"{c} is out of range")) for c, r in table.ranges.items()]
    return F.array_compact(F.array(*checks))


def violations(df: DataFrame, name: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(key, fault): rows with missing, unknown or out-of-range values, repeated keys, and keys without a parent."""
    table = TABLES[name]

    def named(columns) -> Column:
        return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])

    parts = [df.select(named(table.key).alias("key"), F.explode(row_faults(name)).alias("fault"))]
    for columns in (table.key, *table.unique):
        known = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
        parts.append(known.groupBy(named(columns).alias("key")).count().filter("count > 1").select("key", F.lit(f"{', '.join(columns)} is not unique").alias("fault")))
    for column, parent in table.parents.items():
        if parents and parent in parents:
            there = parents[parent].select(F.col("id").alias(column))
            parts.append(df.filter(F.col(column).isNotNull()).join(there, column, "left_anti").select(named(table.key).alias("key"), F.lit(f"{column} has no row in {parent}").alias("fault")))
    return reduce(DataFrame.unionByName, parts)
