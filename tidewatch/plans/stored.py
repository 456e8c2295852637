"""Catalogue queries over a store: ingestion, ranking, serving and account changes, each with SQL that says the same.

``FIXTURE`` says how each table of the store is filled from the test tables, all rows of
them, in SQL that Spark and DuckDB both read; the library's functions then run on that
store, and the SQL twins say what must come out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import scores, text, urls, values
from ..operators import alerts
from ..operators.graph import ready
from ..sources import schemas
from ..sources.store import Store, seed, upsert_links
from ..streaming import ingest as streaming
from ..streaming import ticks
from . import ingest, kept, notify, serve
from .catalogue import _HALF, _LONG, _NEWS, _TOKENS, _event_lines, _WATCH_KEYS, _case, _rules_sql, LN2, NOW, now, query, table

TITLES = ("Clash near Hormuz strait", "Talks on trade rules go on", "Quake hits northern coast", "Central bank lifts key rates", "Protest fills the capital", "Chip plant fire in Taiwan", "Tanker blocked at Suez canal")
PLACES = ("Hormuz", "Suez", "Taiwan Strait", "Geneva", None)
OPERATORS = ("gt", "gte", "lt", "lte", "crosses")


def pick(number: str, values_: tuple) -> str:
    """SQL: the value at ``number`` modulo their count."""
    said = lambda v: "NULL" if v is None else f"'{v}'"
    return f"CASE {number} % {len(values_)} " + " ".join(f"WHEN {n} THEN {said(v)}" for n, v in enumerate(values_)) + " END"


def _place(key: str) -> str:
    return f"CAST(({key} * 7) % 180 - 90 AS DOUBLE) AS lat, CAST(({key} * 13) % 360 - 180 AS DOUBLE) AS lon"


def _after(stamp: str, amount: str, unit: str = "HOUR", sign: str = "+") -> str:
    return f"TIMESTAMP '{stamp}' {sign} INTERVAL '1' {unit} * ({amount})"


def _digits(x: str) -> str:
    """SQL: fifteen significant digits with their zeros."""
    return f"CASE WHEN {x} = 0 THEN '0.00000000000000' ELSE printf('%.' || (14 - floor(log10(abs({x})))::INT) || 'f', {x}) END"


_NULL = "CAST(NULL AS STRING)"
FIXTURE = {
    "sources": f"SELECT concat('src', r_regionkey) AS id, r_name AS name, concat('dom', r_regionkey, '.org') AS domain, {_NULL} AS feed_url, 'api' AS kind, 1 + r_regionkey % 4 AS credibility_tier, 'green' AS license_class, true AS excerpt_allowed, true AS is_active, 0 AS fail_count FROM {{region}}",
    "situations": f"""SELECT concat('s', c_custkey) AS id, concat('slug-', c_custkey) AS slug, concat({pick('c_custkey', TITLES)}, ' ', c_custkey) AS title, {_NULL} AS headline_article_id, {pick('c_custkey', C.CATEGORIES)} AS category,
  {_place('c_custkey')}, {pick('c_custkey', PLACES)} AS geo_name, concat('N', c_nationkey) AS country_iso, {pick('c_custkey', ('archived', 'recent', *['active'] * 8))} AS status,
  {_after('2024-01-20 00:00:00', 'c_custkey % 200')} AS first_seen_at, {_after('2024-01-31 00:00:00', 'c_custkey % 150', sign='-')} AS last_event_at, abs(c_acctbal) / 1000 AS trending_score,
  CASE WHEN c_custkey % 4 <> 0 THEN {_after('2024-01-31 00:00:00', 'c_custkey % 100', sign='-')} END AS score_updated_at, 1.0 AS peak_score, c_custkey % 9 + 1 AS event_count, c_custkey % 6 AS source_count,
  CASE WHEN c_custkey % 10 > 1 AND c_custkey % 25 IN (3, 7, 15) THEN c_custkey END AS map_rank FROM {{customer}}""",
    "events": f"""SELECT concat('e', o_orderkey) AS id, concat('g', o_orderkey) AS gdelt_event_id, '190' AS cameo_code, '19' AS cameo_root, o_orderkey % 4 + 1 AS quad_class, CAST(o_orderkey % 21 - 10 AS DOUBLE) AS goldstein,
  concat('A', o_orderkey % 11) AS actor1_code, concat('Actor ', o_orderkey % 11) AS actor1_name, CASE WHEN o_orderkey % 3 <> 0 THEN concat('B', o_orderkey % 7) END AS actor2_code, {_NULL} AS actor2_name,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST((o_orderkey * 7) % 180 - 90 AS DOUBLE) END AS lat, CAST((o_orderkey * 13) % 360 - 180 AS DOUBLE) AS lon, concat('Place ', o_orderkey % 17) AS geo_name, concat('C', o_orderkey % 5) AS country_iso,
  4 AS geo_precision, {_after('2024-01-10 00:00:00', 'o_orderkey % 30000', 'MINUTE')} AS occurred_at, {_after('2024-01-10 06:00:00', 'o_orderkey % 29000', 'MINUTE')} AS first_seen_at,
  CAST(floor(o_totalprice) AS BIGINT) % 400 AS num_mentions, o_orderkey % 60 AS num_sources, 3 AS num_articles, 0.5 AS avg_tone, {pick('o_orderkey', C.CATEGORIES)} AS category FROM {{orders}}""",
    "situation_events": f"SELECT concat('s', o_custkey) AS situation_id, concat('e', o_orderkey) AS event_id, TIMESTAMP '{NOW}' AS joined_at, 0.6 AS similarity FROM {{orders}}",
    "articles": f"""SELECT concat('a', p_partkey) AS id, concat('src', p_partkey % 5) AS source_id, concat('https://site', p_partkey % 40, '.com/', p_partkey) AS url_canonical, concat('h', p_partkey) AS url_hash, concat(p_name, ' of ', p_type, ' ', p_partkey) AS title,
  p_name AS title_norm, '0' AS title_simhash, CASE WHEN p_partkey % 10 <> 0 THEN {_after('2024-01-15 00:00:00', 'p_partkey % 20000', 'MINUTE')} END AS published_at, TIMESTAMP '{NOW}' AS fetched_at,
  CASE WHEN p_partkey % 6 <> 0 THEN concat('site', p_partkey % 40, '.com') END AS publisher_domain, CASE WHEN p_partkey % 3 = 0 THEN concat('Paper ', p_partkey % 40) END AS publisher_name FROM {{part}}""",
    "event_articles": "SELECT DISTINCT concat('e', l_orderkey) AS event_id, concat('a', l_partkey) AS article_id FROM {lineitem}",
    "assets": f"""SELECT concat('as', s_suppkey) AS id, CASE s_suppkey {' '.join(f"WHEN {n} THEN '{s}'" for n, s in enumerate(C.WATCHABLE_ASSETS))} ELSE concat('S', s_suppkey) END AS symbol, s_name AS name, {pick('s_suppkey', ('fx', 'crypto', 'commodity'))} AS class, 'USD' AS currency,
  'x' AS data_source, CASE WHEN s_suppkey % 5 = 4 THEN 'red' ELSE 'green' END AS license_class, false AS is_delayed, 0 AS delay_minutes FROM {{supplier}}""",
    "asset_prices": "SELECT concat('as', user_id) AS asset_id, ts, value AS price, CASE WHEN event_id % 4 = 0 THEN value / 100 END AS change_pct, ts AS as_of, 'open' AS session_state FROM {events}",
    "outlook_markets": f"""SELECT concat('m', p_partkey) AS id, 'gamma' AS venue, concat('k', p_partkey) AS slug, concat({pick('p_partkey', TITLES)}, ' ', p_name) AS question, concat({pick('p_partkey', TITLES)}, ' ', p_name) AS question_normalised, {_NULL} AS category,
  p_size / 50.0 AS probability, CASE WHEN p_partkey % 3 = 0 THEN 0.25 END AS prev_probability, 0.5 AS prob_change_24h, {_after('2024-01-31 23:30:00', 'p_partkey % 12', sign='-')} AS updated_at, p_partkey % 11 = 0 AS is_resolved FROM {{part}}""",
    "situation_outlook": f"SELECT concat('s', p_partkey % 60) AS situation_id, concat('m', p_partkey) AS market_id, (p_partkey % 10) / 10.0 AS confidence, {pick('p_partkey', ('token', 'category', 'manual'))} AS matched_by, p_partkey % 8 = 0 AS is_manually_verified, 'outlook_match_v1' AS method FROM {{part}}",
    "devices": f"SELECT concat('d', c_custkey) AS id, concat('t', c_custkey) AS apns_token, {_NULL} AS region_iso, c_custkey % 2 = 0 AS is_pro, {_after('2024-01-01 00:00:00', 'c_custkey')} AS created_at, TIMESTAMP '{NOW}' AS last_seen_at FROM {{customer}}",
    "alerts": f"""SELECT concat('al', o_orderkey) AS id, concat('d', o_custkey) AS device_id, 'price' AS kind, {pick('o_orderkey', ('asset', 'situation', 'market'))} AS subject_type, CASE o_orderkey % 3 WHEN 0 THEN concat('as', o_orderkey % 50) WHEN 1 THEN concat('s', o_custkey) ELSE concat('m', o_orderkey % 90) END AS subject_id,
  {pick('o_orderkey', OPERATORS)} AS operator, CASE o_orderkey % 3 WHEN 0 THEN 100.0 WHEN 1 THEN 5.0 ELSE 0.5 END AS threshold, o_orderkey % 2 = 0 AS live_activity, o_orderkey % 7 <> 0 AS is_active,
  CASE WHEN o_orderkey % 4 = 0 THEN {_after('2024-01-31 23:40:00', 'o_orderkey % 19', 'MINUTE')} END AS last_fired_at, 15 AS cooldown_minutes FROM {{orders}}""",
    "device_watches": f"""SELECT concat('d', c_custkey) AS device_id, {pick('c_custkey', tuple(k[0] for k in _WATCH_KEYS))} AS kind, {pick('c_custkey', tuple(k[1] for k in _WATCH_KEYS))} AS symbol, {pick('c_custkey', tuple(k[2] for k in _WATCH_KEYS))} AS exchange,
  {_after('2024-01-20 00:00:00', 'c_custkey % 150')} AS created_at FROM {{customer}}""",
    "watch_deliveries": f"""SELECT concat('d', c_custkey) AS device_id, {pick('c_custkey', tuple(k[0] for k in _WATCH_KEYS))} AS kind, {pick('c_custkey', tuple(k[1] for k in _WATCH_KEYS))} AS symbol, {pick('c_custkey', tuple(k[2] for k in _WATCH_KEYS))} AS exchange,
  concat('s', 28 + 25 * (c_custkey % 4)) AS situation_id, TIMESTAMP '{NOW}' AS delivered_at FROM {{customer}}""",
}
_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


_STANDING: dict[tuple, Store] = {}


def standing(spark, sf_dir: str, *names: str) -> Store:
    """A filled store with its kept views, made once a session, for queries that only read."""
    key = (spark.sparkContext.applicationId, sf_dir, names)
    if key not in _STANDING:
        _STANDING[key] = filled(spark, sf_dir, *names)
        if "situation_events" in names and "articles" in names:
            kept.rebuilt(_STANDING[key])
    return _STANDING[key]


def filled(spark, sf_dir: str, *names: str) -> Store:
    """A new store in the shared folder with these tables filled."""
    ready(spark)
    store = Store(spark, f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}")
    for name in names:
        used = {b: table(spark, sf_dir, b) for b in _BASE if f"{{{b}}}" in FIXTURE[name]}
        rows = spark.sql(FIXTURE[name], **used)
        lists = [f.name for f in schemas.TABLES[name].schema if f.dataType.typeName() == "array"]
        blank = {f.name: F.lit(None) for f in schemas.TABLES[name].schema if f.name not in rows.columns and f.name not in lists}
        store.write(name, rows.withColumns(blank | {c: F.array().cast("array<string>") for c in lists if c not in rows.columns}))
    return store


def twin(sql: str, *names: str) -> str:
    """DuckDB SQL with the filled tables in front, as t_<name>."""
    return "WITH RECURSIVE " + ", ".join(f"t_{n} AS ({FIXTURE[n].format(**{b: b for b in _BASE})})" for n in names) + (", " if sql.lstrip().startswith("~") else " ") + sql.lstrip().lstrip("~")


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _r(name, digits: int = 6):
    return F.round(name, digits).alias(name)


SHOWN = "status = 'active' AND map_rank IS NOT NULL"
LATEST = "row_number() OVER (PARTITION BY asset_id ORDER BY ts DESC)"

# Serving.


@query(twin(f"""
SELECT 'situation' AS section, row_number() OVER (ORDER BY map_rank) - 1 AS pos, id, title AS name, trending_score AS number, last_event_at AS at FROM t_situations WHERE status IN ('active', 'recent') AND map_rank IS NOT NULL
UNION ALL SELECT 'asset', row_number() OVER (ORDER BY symbol) - 1, id, symbol, price, as_of FROM t_assets LEFT JOIN (SELECT *, {LATEST} AS rn FROM t_asset_prices) p ON asset_id = id AND rn = 1 WHERE license_class = 'green'""", "situations", "assets", "asset_prices"))
def serve_now(spark, sf_dir):
    """The snapshot: ranked situations and licensed assets with their latest quote, in their order."""
    snap = serve.now_snapshot(standing(spark, sf_dir, "situations", "assets", "asset_prices"), now())
    s = snap.select(F.lit("situation").alias("section"), F.posexplode("situations").alias("pos", "x")).select("section", F.col("pos").cast("bigint").alias("pos"), "x.id", F.col("x.title").alias("name"), F.col("x.trendingScore").alias("number"), F.col("x.lastEventAt").cast("timestamp_ntz").alias("at"))
    a = snap.select(F.lit("asset").alias("section"), F.posexplode("assets").alias("pos", "x")).select("section", F.col("pos").cast("bigint").alias("pos"), "x.id", F.col("x.symbol").alias("name"), F.col("x.quote.price").alias("number"), F.col("x.quote.asOf").cast("timestamp_ntz").alias("at"))
    return s.unionByName(a)


_CHANGE = f"""~q AS (SELECT *, {LATEST} AS rn FROM t_asset_prices WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL {C.CHANGE_DAYS} DAY),
l AS (SELECT a.asset_id, a.price, a.as_of, coalesce(a.change_pct, CASE WHEN b.price <> 0 THEN (a.price - b.price) / b.price * 100 END) AS change FROM q a LEFT JOIN q b ON b.asset_id = a.asset_id AND b.rn = 2 WHERE a.rn = 1)"""


@query(twin(f"{_CHANGE} SELECT id, symbol, name, class, price, round(change, 6) AS change, as_of FROM t_assets LEFT JOIN l ON asset_id = id WHERE license_class = 'green'", "assets", "asset_prices"))
def serve_markets(spark, sf_dir):
    """Licensed assets with their latest quote; a source's own change comes first, else it is derived."""
    m = serve.markets(standing(spark, sf_dir, "assets", "asset_prices"), now())
    return m.select("id", "symbol", "name", "class", "quote.price", F.round("quote.changePercent", 6).alias("change"), F.col("quote.asOf").cast("timestamp_ntz").alias("as_of"))


@query(twin(f"""~n AS (SELECT symbol, ts, price, row_number() OVER (PARTITION BY symbol ORDER BY ts, price) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM t_asset_prices JOIN t_assets ON asset_id = id
  WHERE license_class = 'green' AND ts >= TIMESTAMP '{NOW}' - INTERVAL {C.QUOTE_DAYS} DAY),
g AS (SELECT DISTINCT symbol, floor(j * ((n - 1) / {float(C.SERIES_POINTS - 1)}) + 0.5)::BIGINT AS i FROM n, range(0, {C.SERIES_POINTS}) t(j) WHERE i = 0 AND n > {C.SERIES_POINTS})
SELECT n.symbol, n.ts, n.price FROM n LEFT JOIN g ON n.symbol = g.symbol AND n.i = g.i WHERE n.n <= {C.SERIES_POINTS} OR g.i IS NOT NULL""", "assets", "asset_prices"))
def serve_history(spark, sf_dir):
    """Thinned series of licensed assets over the days that are kept; more days than that are cut to them."""
    h = serve.history(standing(spark, sf_dir, "assets", "asset_prices"), now(), 90)
    return h.select("symbol", F.explode("points").alias("p")).select("symbol", F.col("p.ts").cast("timestamp_ntz").alias("ts"), "p.price")


_HAY = "SELECT id, category AS c, lower(concat_ws(' ', title, coalesce(geo_name, ''))) AS h FROM t_situations"


@query(twin(f"""~al AS ({_rules_sql(C.ASSET_RULES, f'{_HAY} WHERE {SHOWN}', 1000)}), cl AS ({_rules_sql(C.COMPANY_RULES, f'{_HAY} WHERE {SHOWN}', C.COMPANY_LIMIT_IMPACT)}),
a AS (SELECT id, string_agg(symbol, ',' ORDER BY nth) AS assets FROM al GROUP BY id), f AS (SELECT id, string_agg(symbol, ',' ORDER BY nth) AS companies FROM cl GROUP BY id)
SELECT s.id, title, category, source_count, assets, companies FROM t_situations s LEFT JOIN a USING (id) LEFT JOIN f USING (id) WHERE {SHOWN} AND (assets IS NOT NULL OR companies IS NOT NULL)""", "situations"))
def serve_impact(spark, sf_dir):
    """Ranked situations with linked assets and companies, in rule order."""
    rows = serve.impact(standing(spark, sf_dir, "situations"))
    symbols = lambda c: F.array_join(F.transform(c, lambda x: x["symbol"]), ",").alias(c)
    return rows.select(F.col("situationID").alias("id"), "title", "category", F.col("sourceCount").alias("source_count"), symbols("assets"), symbols("companies"))


_PAGE = "s57"


@query(twin(f"""~m AS (SELECT event_id FROM t_situation_events WHERE situation_id = '{_PAGE}'), h AS ({_HAY} WHERE id = '{_PAGE}'), al AS ({_rules_sql(C.ASSET_RULES, "SELECT * FROM h", 1000)}), cl AS ({_rules_sql(C.COMPANY_RULES, "SELECT * FROM h", C.COMPANY_LIMIT)}), {_CHANGE[1:]}
SELECT 'situation' AS section, id, title AS name, trending_score AS number, last_event_at AS at FROM t_situations WHERE id = '{_PAGE}'
UNION ALL SELECT 'events', id, actor1_name, goldstein, occurred_at FROM t_events WHERE id IN (SELECT event_id FROM m)
UNION ALL SELECT DISTINCT 'news', a.id, coalesce(publisher_name, publisher_domain, s.name), 0.0, published_at FROM t_articles a JOIN t_event_articles x ON x.article_id = a.id JOIN m USING (event_id) JOIN t_sources s ON s.id = a.source_id WHERE published_at IS NOT NULL
UNION ALL SELECT 'outlook', o.id, question, probability, updated_at FROM t_outlook_markets o JOIN t_situation_outlook l ON market_id = o.id WHERE situation_id = '{_PAGE}' AND NOT is_resolved AND (confidence >= {C.OUTLOOK_CONFIDENCE} OR is_manually_verified)
UNION ALL SELECT 'assets', t.id, t.symbol, price, as_of FROM al JOIN t_assets t ON t.symbol = al.symbol LEFT JOIN l ON asset_id = t.id WHERE license_class = 'green'
UNION ALL SELECT 'companies', symbol, rule_id, nth, NULL FROM cl""", "situations", "situation_events", "events", "event_articles", "articles", "sources", "situation_outlook", "outlook_markets", "assets", "asset_prices"))
def serve_situation(spark, sf_dir):
    """All sections of one situation's page: a point lookup, with every row that hangs on it."""
    store = standing(spark, sf_dir, "situations", "situation_events", "events", "event_articles", "articles", "sources", "situation_outlook", "outlook_markets", "assets", "asset_prices")
    page = serve.situation(store, _PAGE, now())
    part = lambda name, key, label, number, at: page[name].select(F.lit(name).alias("section"), F.col(key).alias("id"), F.col(label).alias("name"), F.lit(0.0).alias("number") if number is None else F.col(number).cast("double").alias("number"), at.cast("timestamp_ntz").alias("at"))
    out = part("situation", "id", "title", "trendingScore", F.col("lastEventAt")).unionByName(part("events", "id", "actor1Name", "goldstein", F.col("occurredAt")))
    out = out.unionByName(part("news", "id", "sourceName", None, F.col("publishedAt"))).unionByName(part("outlook", "id", "question", "probability", F.col("updatedAt")))
    firms = page["companies"].withColumn("nth", F.lit(0.0))
    out = out.unionByName(part("impactedAssets", "id", "symbol", "quote.price", F.col("quote.asOf")).withColumn("section", F.lit("assets")))
    nth = {s: n for n, s in enumerate(r["symbol"] for r in page["companies"].collect())}  # at most COMPANY_LIMIT rows, in their order
    number = F.create_map(F.lit(""), F.lit(0.0), *[F.lit(x) for s, n in nth.items() for x in (s, float(n + 1))])
    return out.unionByName(firms.select(F.lit("companies").alias("section"), F.col("symbol").alias("id"), F.col("rule_id").alias("name"), number[F.col("symbol")].alias("number"), F.lit(None).cast("timestamp_ntz").alias("at")))


_FIRMS = ", ".join(f"('{s}', '{v[0]}')" for s, v in C.COMPANIES.items())


@query(twin(f"""(SELECT 'situations' AS section, id, title AS name, trending_score AS score FROM t_situations WHERE title ILIKE '%er%' ORDER BY trending_score DESC, id LIMIT {C.SEARCH_LIMIT})
UNION ALL (SELECT 'assets', id, name, 1.0 FROM t_assets WHERE license_class = 'green' AND (symbol ILIKE '%er%' OR name ILIKE '%er%') ORDER BY symbol LIMIT {C.SEARCH_LIMIT})
UNION ALL (SELECT 'companies', symbol, name, 0.0 FROM (VALUES {_FIRMS}) v(symbol, name) WHERE contains(lower(symbol), 'er') OR contains(lower(name), 'er') ORDER BY symbol LIMIT {C.SEARCH_LIMIT})""", "situations", "assets"))
def serve_search(spark, sf_dir):
    """Names that hold a text, the best twenty of each kind."""
    found = serve.search(standing(spark, sf_dir, "situations", "assets"), " er ")
    part = lambda kind, key, name, score: found[kind].select(F.lit(kind).alias("section"), F.col(key).alias("id"), F.col(name).alias("name"), score.cast("double").alias("score"))
    return part("situations", "id", "title", F.col("score")).unionByName(part("assets", "id", "name", F.col("score"))).unionByName(part("companies", "symbol", "name", F.lit(0)))


@query(twin(f"""~s AS (SELECT id, {_TOKENS.format('title')} AS t, url_canonical FROM t_articles), e AS (SELECT id, list_filter(['actor:' || actor1_code, 'actor:' || actor2_code, 'geo:' || country_iso], lambda x: x IS NOT NULL) AS g FROM t_events),
m AS (SELECT situation_id, event_id FROM t_situation_events JOIN t_situations ON id = situation_id WHERE status = 'active'),
g AS (SELECT situation_id, list_sort(list_distinct(flatten(list(g)))) AS signature FROM m JOIN e ON e.id = event_id GROUP BY 1),
w AS (SELECT situation_id, list_sort(list_distinct(flatten(list(t)))) AS tokens, count(DISTINCT url_canonical) AS urls FROM m JOIN t_event_articles USING (event_id) JOIN s ON s.id = article_id GROUP BY 1)
SELECT id, array_to_string(coalesce(signature, []), '|') AS signature, array_to_string(coalesce(tokens, []), '|') AS tokens, coalesce(urls, 0)::INT AS urls FROM t_situations LEFT JOIN g ON g.situation_id = id LEFT JOIN w ON w.situation_id = id WHERE status = 'active'""", "situations", "situation_events", "events", "event_articles", "articles"))
def active_states(spark, sf_dir):
    """Marks, headline words and addresses of every active situation, through the link tables."""
    rows = ingest.active_states(standing(spark, sf_dir, "situations", "situation_events", "events", "event_articles", "articles"))
    line = lambda c: F.array_join(F.array_sort(c), "|").alias(c)
    return rows.select("id", line("signature"), line("tokens"), F.size("urls").alias("urls"))


@query(twin("""SELECT DISTINCT event_id AS id FROM t_situation_events JOIN (SELECT id FROM t_situations WHERE event_count > 0) s ON s.id = situation_id""", "situations", "situation_events"))
def known_events(spark, sf_dir):
    """Events whose situation was aggregated."""
    return ingest.known_events(standing(spark, sf_dir, "situations", "situation_events"))


# Ingestion, ranking, markets.

_ARRIVED = "CAST(substr(event_id, 2) AS BIGINT) % 3 = 0"
_VELOCITY = f"least(1.0, ln(1 + num_mentions) / ln(1 + {C.VELOCITY_MENTIONS}))"
_CONFIRMED = f"least(1.0, ln(1 + publishers) / ln(1 + {C.CONFIRMATION_SOURCES}))"
_WEIGHTS = scores.available_weights()


@query(twin(f"""~touched AS (SELECT DISTINCT situation_id FROM t_situation_events WHERE {_ARRIVED}), member AS (SELECT situation_id, event_id FROM t_situation_events JOIN touched USING (situation_id)),
pages AS (SELECT situation_id, event_id, article_id, a.title, publisher_domain FROM member JOIN t_event_articles USING (event_id) JOIN t_articles a ON a.id = article_id),
numbers AS (SELECT situation_id, count(DISTINCT publisher_domain) AS publishers, count(DISTINCT article_id) AS articles FROM pages GROUP BY 1),
headline AS (SELECT situation_id, article_id AS h_article, title AS h_title FROM (SELECT p.*, row_number() OVER (PARTITION BY situation_id ORDER BY num_mentions DESC, first_seen_at DESC, event_id, article_id) AS k FROM pages p JOIN t_events e ON e.id = event_id) WHERE k = 1),
anchor AS (SELECT situation_id, lat AS a_lat, lon AS a_lon, geo_name AS a_geo, country_iso AS a_iso FROM (SELECT situation_id, e.*, row_number() OVER (PARTITION BY situation_id ORDER BY num_mentions DESC, first_seen_at, event_id) AS k FROM member JOIN t_events e ON e.id = event_id WHERE lat IS NOT NULL) WHERE k = 1),
fresh AS (SELECT situation_id, max(first_seen_at) AS newest, sum({_VELOCITY} * {_WEIGHTS['newsVelocity']!r} + {_CONFIRMED} * {_WEIGHTS['sourceConfirmation']!r} + 0.5 * {_WEIGHTS['severity']!r}) AS impulse
  FROM t_situation_events JOIN t_events e ON e.id = event_id JOIN numbers USING (situation_id) WHERE {_ARRIVED} GROUP BY 1),
s AS (SELECT t.*, h_article, h_title, a_lat, a_lon, a_geo, a_iso, publishers, articles, newest, impulse,
  trending_score * exp(-{LN2} / ({_HALF}) * greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(coalesce(score_updated_at, last_event_at))) / 3.6e9, 0)) + greatest(impulse, 0) AS score
  FROM t_situations t JOIN numbers n ON n.situation_id = t.id JOIN headline h ON h.situation_id = t.id JOIN fresh f ON f.situation_id = t.id LEFT JOIN anchor a ON a.situation_id = t.id)
SELECT id, h_title AS title, h_article AS headline_article_id, coalesce(a_lat, lat) AS lat, coalesce(a_lon, lon) AS lon, a_geo AS geo_name, a_iso AS country_iso, greatest(last_event_at, newest) AS last_event_at, articles AS event_count, publishers AS source_count,
  round(score, 6) AS trending_score, round(greatest(peak_score, score), 6) AS peak_score, round(score, 6) AS logged FROM s""", "situations", "situation_events", "events", "event_articles", "articles"))
def situation_aggregate(spark, sf_dir):
    """Counts, headline, place, score and history of all touched situations: every third event has just arrived."""
    store = filled(spark, sf_dir, "situations", "situation_events", "events", "event_articles", "articles")
    arrived = store.read("situation_events").filter(_ARRIVED).select("situation_id", "event_id")
    rows = arrived.join(store.read("events").withColumnRenamed("id", "event_id"), "event_id").withColumn("severity", F.lit(0.5))
    ingest.aggregate(store, arrived.select("situation_id").distinct(), rows, now())
    log = store.read("score_history").select(F.col("situation_id").alias("id"), _r("score").alias("logged"))
    return store.read("situations").join(log, "id").select("id", "title", "headline_article_id", "lat", "lon", "geo_name", "country_iso", _ntz("last_event_at"), "event_count", "source_count", _r("trending_score"), _r("peak_score"), "logged")


@query(twin(f"""~a AS (SELECT *, CASE WHEN status = 'active' AND last_event_at < TIMESTAMP '{NOW}' - INTERVAL {C.ACTIVE_HOURS} HOUR THEN 'recent' ELSE status END AS s1 FROM t_situations),
b AS (SELECT *, CASE WHEN s1 = 'recent' AND last_event_at < TIMESTAMP '{NOW}' - INTERVAL {24 * C.ARCHIVE_DAYS} HOUR THEN 'archived' ELSE s1 END AS s2 FROM a),
v AS (SELECT *, s2 = 'active' AND source_count >= {C.VISIBLE_SOURCES} AS shown, trending_score * exp(-{LN2} / ({_HALF}) * greatest((epoch_us(TIMESTAMP '{NOW}') - epoch_us(coalesce(score_updated_at, last_event_at))) / 3.6e9, 0)) AS score FROM b),
c AS (SELECT id, score, row_number() OVER (PARTITION BY country_iso ORDER BY score DESC, id) AS k FROM v WHERE shown), t AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM c WHERE k <= {C.PER_COUNTRY})
SELECT v.id, s2 AS status, round(CASE WHEN shown THEN score ELSE trending_score END, 6) AS trending_score, CASE WHEN shown THEN TIMESTAMP '{NOW}' ELSE score_updated_at END AS score_updated_at,
  (CASE WHEN shown THEN r WHEN s2 = status THEN map_rank END)::INT AS map_rank FROM v LEFT JOIN t ON t.id = v.id AND r <= {C.TOP_N}""", "situations"))
def ranking_tick(spark, sf_dir):
    """All situations aged, the visible ones decayed to now and ranked from one on under the country cap."""
    store = filled(spark, sf_dir, "situations")
    ingest.ranking_tick(store, now())
    return store.read("situations").select("id", "status", _r("trending_score"), _ntz("score_updated_at"), "map_rank")


@query(twin(f"""SELECT a.id AS asset_id, TIMESTAMP '{NOW}' AS ts, p_retailprice AS price FROM part JOIN t_assets a ON a.symbol = concat('S', p_partkey) WHERE license_class = 'green'
UNION ALL SELECT asset_id, ts, price FROM t_asset_prices WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 20 DAY""", "assets", "asset_prices"))
def quote_run(spark, sf_dir):
    """Quotes of licensed assets stored, older ones than twenty days dropped."""
    store = filled(spark, sf_dir, "assets", "asset_prices")
    quotes = table(spark, sf_dir, "part").select(F.concat(F.lit("S"), "p_partkey").alias("symbol"), F.col("p_retailprice").alias("price"), F.lit(None).cast("double").alias("change_percent"), now().alias("as_of"), F.lit("open").alias("session_state"))
    for _ in range(2):  # the second changes nothing
        ingest.quote_run(store, quotes, now())
    ingest.quote_retention(store, now(), 20)
    return store.read("asset_prices").select("asset_id", _ntz("ts"), "price")


_FOUND = f"SELECT concat('n', p_partkey) AS id, concat('k', p_partkey) AS slug, concat({pick('p_partkey + 1', TITLES)}, ' now') AS question, {_NULL} AS end_date, 1.0 AS volume, 2.0 AS liquidity, CASE WHEN p_partkey % 4 = 0 THEN p_size / 50.0 ELSE 0.125 END AS probability, 0.0 AS prob_change_24h FROM {{part}} WHERE p_partkey % 2 = 0"


@query(twin(f"""~f AS ({_FOUND.format(part='part')}), m AS (SELECT coalesce(o.id, f.id) AS id, coalesce(f.question, o.question_normalised) AS q, coalesce(f.probability, o.probability) AS probability, CASE WHEN f.slug IS NULL OR f.probability = o.probability THEN o.prev_probability ELSE o.probability END AS prev,
  CASE WHEN f.slug IS NULL AND o.updated_at < TIMESTAMP '{NOW}' - INTERVAL {C.OUTLOOK_STALE_HOURS} HOUR THEN true WHEN f.slug IS NULL THEN o.is_resolved ELSE false END AS resolved FROM t_outlook_markets o FULL JOIN f USING (slug)),
s AS (SELECT id, {_LONG.format('title')} AS t FROM t_situations WHERE {SHOWN}), k AS (SELECT id, {_LONG.format('q')} AS t FROM m WHERE NOT resolved),
l AS (SELECT s.id AS situation_id, k.id AS market_id, least(1.0, len(list_intersect(s.t, k.t)) / greatest(1, least(len(s.t), len(k.t))) * 0.8) AS c FROM s, k),
n AS (SELECT * FROM l WHERE c >= {C.OUTLOOK_CONFIDENCE})
SELECT 'market' AS kind, id, NULL AS other, probability AS number, prev, resolved AS flag FROM m
UNION ALL SELECT 'link', coalesce(n.situation_id, o.situation_id), coalesce(n.market_id, o.market_id), round(CASE WHEN o.matched_by = 'manual' OR n.c IS NULL THEN o.confidence ELSE n.c END, 9), NULL, coalesce(o.is_manually_verified, false)
  FROM n FULL JOIN t_situation_outlook o ON o.situation_id = n.situation_id AND o.market_id = n.market_id""", "situations", "outlook_markets", "situation_outlook"))
def outlook_run(spark, sf_dir):
    """Fetched questions over stored ones: previous probabilities, stale ones retired, new links, manual links untouched."""
    store = filled(spark, sf_dir, "situations", "outlook_markets", "situation_outlook")
    ingest.outlook_run(store, spark.sql(_FOUND, part=table(spark, sf_dir, "part")), now())
    m = store.read("outlook_markets").select(F.lit("market").alias("kind"), "id", F.lit(None).cast("string").alias("other"), F.col("probability").alias("number"), F.col("prev_probability").alias("prev"), F.col("is_resolved").alias("flag"))
    return m.unionByName(store.read("situation_outlook").select(F.lit("link").alias("kind"), F.col("situation_id").alias("id"), F.col("market_id").alias("other"), F.round("confidence", 9).alias("number"), F.lit(None).cast("double").alias("prev"), F.col("is_manually_verified").alias("flag")))


@query(twin("""SELECT situation_id, market_id, CASE WHEN situation_id = 's1' AND market_id = 'm1' THEN 1.0 WHEN matched_by = 'manual' THEN confidence ELSE 0.75 END AS confidence, is_manually_verified OR (situation_id = 's1' AND market_id = 'm1') AS verified, 'US' AS region, false AS enabled FROM t_situation_outlook""", "situation_outlook"))
def manual_links(spark, sf_dir):
    """A link set by hand, then a run that would set all confidences; a region switched off."""
    store = filled(spark, sf_dir, "situation_outlook")
    ingest.set_manual_link(store, "s1", "m1", True)
    again = store.read("situation_outlook").withColumns({"confidence": F.lit(0.75), "matched_by": F.lit("token")})
    store.write("situation_outlook", upsert_links(store.read("situation_outlook"), again))
    ingest.set_region(store, "us", False, "test", now())
    switch = store.read("outlook_controls").select(F.col("region_iso").alias("region"), F.lit(ingest.region_enabled(store, "Us") or not ingest.region_enabled(store, "FR")).alias("enabled"))
    return store.read("situation_outlook").select("situation_id", "market_id", "confidence", F.col("is_manually_verified").alias("verified")).join(F.broadcast(switch))


INTERVALS = ("20240101001500", "20240101003000", "20240101004500")


def _files(spark, sf_dir: str) -> tuple[str, str, Callable[[], None]]:
    """Folders with three intervals of event and article files, a third of the events each and one headline a story; the last brings the second's articles, which are late."""
    ready(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/feed-{uuid.uuid4().hex}"
    col = F.col
    events = _event_lines(spark, sf_dir)
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    words = F.concat_ws(" ", F.lit("report"), F.concat(F.lit("place"), col("user_id") % 12), F.concat(F.lit("actor"), col("user_id") % 9), F.concat(F.lit("story"), "user_id"))
    cells = {1: F.lit("20240101"), 3: F.concat(F.lit("src"), col("user_id") % 7), 4: F.concat(F.lit("https://www.site.com/a/"), "user_id", F.lit("?b=1&a=2")), 8: F.when(col("user_id") % 3 == 0, "PROTEST,1").otherwise("TAX,1"), 26: F.concat(F.lit("<PAGE_TITLE>"), words, F.lit("</PAGE_TITLE>"))}
    articles = u.select(F.concat_ws("\t", *[cells.get(i, F.lit("")) for i in range(27)]).alias("value"))

    def put(rows: DataFrame, folder: str, name: str) -> None:
        """An interval is one file, as the feed has it."""
        rows.select("value").coalesce(1).write.text(f"{root}/_{name}")
        make = spark._jvm.org.apache.hadoop.fs.Path
        fs = make(root).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(make(f"{root}/{folder}"))
        part = next(s.getPath() for s in fs.listStatus(make(f"{root}/_{name}")) if s.getPath().getName().startswith("part-"))
        fs.rename(part, make(f"{root}/{folder}/{name}"))

    late = INTERVALS[1]
    for n, ts in enumerate(INTERVALS):
        put(events.filter(col("seq") % 3 == n), "e", f"{ts}.export.CSV")
        if ts != late:
            put(articles, "a", f"{ts}.gkg.csv")
    return f"{root}/e", f"{root}/a", lambda: put(articles, "a", f"{late}.gkg.csv")


@query(f"""
WITH {_NEWS}, f AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY severity DESC, mentions DESC, event_id) AS k
  FROM news WHERE event_id % 10 <> 3 AND event_id % 6 <> 0 AND severity >= {C.SEVERITY_FLOOR} AND user_id % 3 = 0 AND (event_id % 2 = 0 OR user_id % 3 <> event_id % 3)),
c AS (SELECT 'gdelt-' || event_id AS id, 'https://site.com/a/' || user_id || '?a=2&b=1' AS url, user_id FROM f WHERE k = 1)
SELECT 'event' AS kind, id AS key, NULL AS other FROM c UNION ALL SELECT 'member', id, NULL FROM c UNION ALL SELECT DISTINCT 'article', url, 'report place' || user_id % 12 || ' actor' || user_id % 9 || ' story' || user_id FROM c
UNION ALL SELECT 'link', id, 'art-' || substr(sha1(url), 1, 16) FROM c UNION ALL SELECT 'run', 'success', unnest({list(INTERVALS)}) UNION ALL SELECT 'start', unnest(['1', '2', '2']), unnest({list(INTERVALS)}) UNION ALL SELECT 'mark', unnest(['1', '2']), unnest(['{INTERVALS[0]}', '{INTERVALS[2]}'])""")
def stream_ingest(spark, sf_dir):
    """Three intervals through the store by the stream, the second's article file late: the first start stops before it, the second goes on; a catch-up then finds nothing.

    What is stored, that each event is in exactly one situation, the runs with their intervals, what each start did, and the mark after it.
    """
    exports, articles, arrive = _files(spark, sf_dir)
    store = Store(spark, f"{exports}-store")
    first, said = "20240101000000", []
    for start in ("1", "2"):
        streaming.stream(store, exports, articles, f"{exports}-state", first, now(), lambda _, counts, start=start: said.append(("start", start, counts["ts"]))).awaitTermination()
        said.append(("mark", start, streaming.high_water(store, first)))
        if start == "1":
            arrive()
    said += [("start", "catch-up", counts["ts"]) for counts in streaming.run_pending(store, exports, articles, first, now())]
    none = F.lit(None).cast("string")
    part = lambda name, kind, key, other=none: store.read(name).select(F.lit(kind).alias("kind"), key.alias("key"), other.alias("other"))
    out = part("events", "event", F.col("id")).union(part("situation_events", "member", F.col("event_id"))).union(part("articles", "article", F.col("url_canonical"), F.col("title")))
    out = out.union(part("event_articles", "link", F.col("event_id"), F.col("article_id"))).union(part("ingest_runs", "run", F.col("status"), F.get_json_object("counts_json", "$.last_interval")))
    return out.union(spark.createDataFrame(said, "kind string, key string, other string"))


# Accounts, alerts, watches.


@query(twin(f"""SELECT id, CASE WHEN id = 'd1' THEN 't2' ELSE apns_token END AS apns_token, CASE WHEN id = 'd1' THEN 'US' END AS region_iso, is_pro, created_at FROM t_devices WHERE id <> 'd2' UNION ALL SELECT 'new', 'tn', NULL, false, TIMESTAMP '{NOW}'""", "devices"))
def device_register(spark, sf_dir):
    """A device takes over another's token, and a new one comes; times of the first visit stay."""
    store = filled(spark, sf_dir, "devices")
    serve.register_device(store, "d1", "t2", "US", now())
    serve.register_device(store, "new", "tn", None, now())
    return store.read("devices").select("id", "apns_token", "region_iso", "is_pro", _ntz("created_at"))


@query(twin("""SELECT 'devices' AS name, id AS key FROM t_devices WHERE id <> 'd3' UNION ALL SELECT 'alerts', id FROM t_alerts WHERE device_id <> 'd3' UNION ALL SELECT 'watches', device_id FROM t_device_watches WHERE device_id <> 'd3'
UNION ALL SELECT 'sent', device_id || situation_id FROM t_watch_deliveries WHERE device_id <> 'd3'""", "devices", "alerts", "device_watches", "watch_deliveries"))
def device_remove(spark, sf_dir):
    """A device goes with all that hangs on it."""
    store = filled(spark, sf_dir, "devices", "alerts", "device_watches", "watch_deliveries")
    serve.remove_device(store, "d3")
    part = lambda name, label, key: store.read(name).select(F.lit(label).alias("name"), key.alias("key"))
    return part("devices", "devices", F.col("id")).union(part("alerts", "alerts", F.col("id"))).union(part("device_watches", "watches", F.col("device_id"))).union(part("watch_deliveries", "sent", F.concat("device_id", "situation_id")))


@query(twin("""SELECT id, subject_type AS "subjectType", subject_id AS "subjectID", operator, CASE WHEN id = (SELECT min(id) FROM t_alerts WHERE device_id = 'd5') THEN 7.5 ELSE threshold END AS threshold, is_active AS "isActive", cooldown_minutes AS "cooldownMinutes"
FROM t_alerts WHERE device_id = 'd5' AND id <> (SELECT max(id) FROM t_alerts WHERE device_id = 'd5')""", "alerts"))
def device_alerts(spark, sf_dir):
    """Alerts of a device after one was changed and one dropped; what a change leaves out stays."""
    store = filled(spark, sf_dir, "alerts")
    own = store.read("alerts").filter("device_id = 'd5'").agg(F.min("id").alias("a"), F.max("id").alias("z")).first()
    serve.change_alert(store, "d5", own["a"], threshold=7.5)
    serve.drop_alert(store, "d5", own["z"])
    serve.drop_alert(store, "d6", own["a"])  # another's alert stays
    return serve.device_alerts(store, "d5").select("id", "subjectType", "subjectID", "operator", "threshold", "isActive", "cooldownMinutes")


_NEW_ALERTS = f"SELECT concat('na', p_partkey) AS id, concat('d', p_partkey % 200) AS device_id, {pick('p_partkey', ('price', 'price', 'price', 'price', 'odd'))} AS kind, 'asset' AS subject_type, concat('as', p_partkey % 12) AS subject_id, {pick('p_partkey', (*OPERATORS, 'near'))} AS operator, p_retailprice AS threshold, false AS live_activity, true AS is_active, 15 AS cooldown_minutes FROM {{part}}"


@query(twin(f"""~n AS ({_NEW_ALERTS.format(part='part')}) SELECT n.id, CASE WHEN n.kind = 'odd' OR operator = 'near' THEN 'unsupported alert kind, subject, or operator' WHEN a.id IS NULL THEN 'unknown or unlicensed asset' WHEN d.id IS NULL THEN 'device not found' ELSE 'stored' END AS why
FROM n LEFT JOIN t_assets a ON a.id = n.subject_id AND license_class = 'green' LEFT JOIN t_devices d ON d.id = n.device_id""", "assets", "devices"))
def alerts_added(spark, sf_dir):
    """New alerts: refused ones with why, the others stored."""
    store = filled(spark, sf_dir, "assets", "devices")
    rows = spark.sql(_NEW_ALERTS, part=table(spark, sf_dir, "part")).withColumns({c: F.lit(None) for c in ("window_minutes", "combinator_group_id", "last_fired_at")})
    ready(spark)
    refused = serve.add_alerts(store, rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES["alerts"].schema])).select("id", "why")
    return refused.union(store.read("alerts").select("id", F.lit("stored").alias("why")))


@query(twin(f"""SELECT device_id, kind, symbol, exchange, created_at FROM t_device_watches WHERE device_id <> 'd1' UNION ALL SELECT 'd1', k.kind, k.symbol, k.exchange, coalesce(w.created_at, TIMESTAMP '{NOW}')
FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _WATCH_KEYS[:9])}) k(kind, symbol, exchange) LEFT JOIN t_device_watches w ON w.device_id = 'd1' AND w.symbol = k.symbol AND w.kind = k.kind""", "device_watches"))
def watches_replaced(spark, sf_dir):
    """A device's watches set anew; a kept one keeps its first time."""
    store = filled(spark, sf_dir, "devices", "device_watches")
    serve.replace_watches(store, "d1", spark.createDataFrame(_WATCH_KEYS[:9], "kind string, symbol string, exchange string"), now())
    return store.read("device_watches").select("device_id", "kind", "symbol", "exchange", _ntz("created_at"))


class Box:
    """A sender that takes all but tokens that end in a five, which are dead."""

    def send(self, token: str, payload: dict) -> None:
        if token.endswith("5"):
            raise notify.SendError(410, "Unregistered")


_SUBJECTS = f"""p AS (SELECT asset_id, price, {LATEST} AS rn FROM t_asset_prices),
u AS (SELECT 'asset' AS st, a.asset_id AS sid, a.price AS cur, b.price AS prev FROM p a LEFT JOIN p b ON b.asset_id = a.asset_id AND b.rn = 2 WHERE a.rn = 1
  UNION ALL SELECT 'situation', id, trending_score, NULL FROM t_situations UNION ALL SELECT 'market', id, probability, prev_probability FROM t_outlook_markets WHERE NOT is_resolved),
due AS (SELECT a.*, apns_token, cur, sha256(concat_ws('|', a.id, strftime(TIMESTAMP '{NOW}', '%Y-%m-%dT%H:%M:%S.000Z'), {_digits('cur')})) AS key FROM t_alerts a JOIN t_devices d ON d.id = device_id JOIN u ON st = subject_type AND sid = subject_id
  WHERE is_active AND CASE operator WHEN 'gt' THEN cur > threshold WHEN 'gte' THEN cur >= threshold WHEN 'lt' THEN cur < threshold WHEN 'lte' THEN cur <= threshold ELSE coalesce((prev < threshold AND cur >= threshold) OR (prev > threshold AND cur <= threshold), false) END
  AND NOT coalesce((epoch_us(TIMESTAMP '{NOW}') - epoch_us(last_fired_at)) / 6e7 < cooldown_minutes, false))"""
_ALERTED = ("alerts", "devices", "asset_prices", "situations", "outlook_markets")


@query(twin(f"~{_SUBJECTS} SELECT id, device_id, cur AS current, key AS payload_hash FROM due WHERE CAST(substr(id, 3) AS BIGINT) % 4 <> 1", *_ALERTED))
def alerts_undelivered(spark, sf_dir):
    """Due alerts less those that were delivered with this very value: each fourth was."""
    store = filled(spark, sf_dir, *_ALERTED)
    subjects = alerts.current_values(store.read("asset_prices"), store.read("situations"), store.read("outlook_markets"))
    due = lambda sent: alerts.due_alerts(store.read("alerts"), store.read("devices"), subjects, sent, now())
    first = due(store.read("alert_deliveries"))
    store.write("alert_deliveries", first.filter("CAST(substr(id, 3) AS BIGINT) % 4 = 1").select(F.col("id").alias("alert_id"), now().alias("fired_at"), "payload_hash"))
    return due(store.read("alert_deliveries")).select("id", "device_id", "current", "payload_hash")


@query(twin(f"""~{_SUBJECTS} SELECT 'sent' AS kind, id, key AS note FROM due WHERE apns_token NOT LIKE '%5' UNION ALL SELECT 'device', id, NULL FROM t_devices WHERE apns_token NOT IN (SELECT apns_token FROM due WHERE apns_token LIKE '%5')
UNION ALL SELECT 'fired', id, NULL FROM due WHERE apns_token NOT LIKE '%5'""", *_ALERTED))
def alert_tick(spark, sf_dir):
    """Due alerts sent and recorded, dead devices removed; a second tick at once sends nothing."""
    store = filled(spark, sf_dir, *_ALERTED)
    for _ in range(2):
        notify.alert_tick(store, Box(), now(), 0)
    sent = store.read("alert_deliveries").select(F.lit("sent").alias("kind"), F.col("alert_id").alias("id"), F.col("payload_hash").alias("note"))
    none = F.lit(None).cast("string").alias("note")
    fired = store.read("alerts").filter(F.col("last_fired_at") == now()).select(F.lit("fired").alias("kind"), "id", none)
    return sent.union(store.read("devices").select(F.lit("device").alias("kind"), "id", none)).union(fired)


@query(twin(f"""~shown AS (SELECT * FROM t_situations WHERE {SHOWN}), hay AS ({_HAY} WHERE {SHOWN}),
h AS (SELECT id, 'company' AS kind, symbol FROM ({_rules_sql(C.COMPANY_RULES, 'SELECT * FROM hay', C.COMPANY_LIMIT_WATCH)}) UNION ALL SELECT id, 'asset', symbol FROM ({_rules_sql(C.ASSET_RULES, 'SELECT * FROM hay', 1000)})),
r AS (SELECT w.*, h.id AS situation_id, row_number() OVER (PARTITION BY w.device_id ORDER BY h.id, w.kind, w.symbol, w.exchange) AS nth FROM t_device_watches w JOIN t_devices d ON d.id = w.device_id JOIN h ON h.kind = w.kind AND h.symbol = w.symbol JOIN shown s ON s.id = h.id
  LEFT JOIN t_watch_deliveries x ON x.device_id = w.device_id AND x.kind = w.kind AND x.symbol = w.symbol AND x.exchange = w.exchange AND x.situation_id = h.id WHERE s.first_seen_at >= w.created_at AND x.device_id IS NULL)
SELECT 'sent' AS kind, device_id, symbol, situation_id FROM r WHERE nth <= {C.MAX_PUSHES} AND device_id NOT LIKE '%5' UNION ALL SELECT 'sent', device_id, symbol, situation_id FROM t_watch_deliveries
UNION ALL SELECT 'device', id, NULL, NULL FROM t_devices WHERE id NOT IN (SELECT device_id FROM r WHERE device_id LIKE '%5')""", "situations", "devices", "device_watches", "watch_deliveries"))
def watch_tick(spark, sf_dir):
    """Pushes for watched names: not older than the watch, not yet sent, three a device; dead devices removed."""
    store = filled(spark, sf_dir, "situations", "devices", "device_watches", "watch_deliveries")
    notify.watch_tick(store, Box(), now(), pause=0)
    sent = store.read("watch_deliveries").select(F.lit("sent").alias("kind"), "device_id", "symbol", "situation_id")
    none = F.lit(None).cast("string")
    return sent.union(store.read("devices").select(F.lit("device").alias("kind"), F.col("id").alias("device_id"), none.alias("symbol"), none.alias("situation_id")))


@query(" UNION ALL ".join(f"SELECT '{name}' AS job, min(ts) AS at FROM events WHERE ts IS NOT NULL GROUP BY time_bucket(INTERVAL {minutes} MINUTE, ts)" for name, minutes in ticks.PERIODS.items()))
def tick_schedule(spark, sf_dir):
    """Each event's time as a tick: which of them run which periodic job."""
    return ticks.due_ticks(table(spark, sf_dir, "events").select(F.col("ts").alias("at")))


# Registers, addresses, digests.


@query("""SELECT concat('src', s_suppkey) AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' b' ELSE s_name END AS name, 'api' AS kind, 0::BIGINT AS fail_count, true AS is_active FROM supplier""")
def register_seeds(spark, sf_dir):
    """Register rows put in, and every other one put over."""
    ready(spark)
    store = Store(spark, f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}")
    s = table(spark, sf_dir, "supplier")
    rows = lambda name: s.select("s_suppkey", F.concat(F.lit("src"), "s_suppkey").alias("id"), name.alias("name"), F.lit("a.org").alias("domain"), F.lit("api").alias("kind"), F.lit(1).alias("credibility_tier"), F.lit("green").alias("license_class"))
    seed(store, "sources", rows(F.col("s_name")).drop("s_suppkey"))
    seed(store, "sources", rows(F.concat("s_name", F.lit(" b"))).filter("s_suppkey % 2 = 0").drop("s_suppkey"))
    return store.read("sources").select("id", "name", "kind", "fail_count", "is_active")


@query(
    """SELECT page_id, 'https://www.google.com/finance/quote/' || 'A%26' || page_id || '%20B' || ':NYSE' AS quote_url, CASE page_id % 5 WHEN 0 THEN 7.0 WHEN 1 THEN 1.0 WHEN 2 THEN 30.0 WHEN 3 THEN 7.0 ELSE 12.5 END AS days,
  coalesce(nullif(substr(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), ''), 'situation') || '-' || substr(sha1(page_id::VARCHAR), 1, 6) AS slug, 'art-' || substr(sha1(url), 1, 16) AS article_id,
  sha256(concat_ws('|', 'al' || page_id, '2024-01-01', """
    + _digits("(page_id / 8.0 + 1)")
    + """)) AS delivery_key,
  CASE WHEN page_id % 3 = 0 THEN 'paper ' || page_id ELSE regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1)), '^www\\.', '') END AS publisher FROM pages"""
)
def address_helpers(spark, sf_dir):
    """Quote addresses, asked days, slugs, article ids, delivery digests and publishers."""
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    days = F.element_at(F.array(*map(F.lit, ("", "0.25", "99", "x", "12.5"))), (i % 5 + 1).cast("int"))
    name = F.when(i % 3 == 0, F.concat(F.lit("Paper "), i)).otherwise(F.lit(""))
    return p.select(
        "page_id", urls.quote_url(F.concat(F.lit("A&"), i, F.lit(" B")), F.lit("NYSE")).alias("quote_url"), values.clamped_days(days).alias("days"), text.slug(F.col("url"), i.cast("string")).alias("slug"), text.article_id(F.col("url")).alias("article_id"),
        alerts.delivery_key(F.concat(F.lit("al"), i), F.lit("2024-01-01"), i / 8.0 + 1).alias("delivery_key"), ingest.publisher(name, F.col("url")).alias("publisher"),
    )

