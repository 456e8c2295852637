"""Readers of raw feeds: each a text or JSON scan, split and projected at once."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.text import decode_entities
from ..functions.urls import canonical_url
from ..functions.values import number, trimmed

EVENT_FIELDS = 61
#: Field of the event file: its place (fixed values).
EVENT_COLUMNS = {
    "global_event_id": 0, "sql_date": 1, "actor1_code": 5, "actor1_name": 6, "actor1_country": 7, "actor2_code": 15, "actor2_name": 16,
    "actor2_country": 17, "event_code": 26, "event_root_code": 28, "quad_class": 29, "goldstein": 30, "num_mentions": 31, "num_sources": 32,
    "num_articles": 33, "avg_tone": 34, "geo_type": 51, "geo_name": 52, "geo_country": 53, "lat": 56, "lon": 57, "date_added": 59, "source_url": 60,
}
ARTICLE_COLUMNS = {"date": 1, "source_name": 3, "url": 4, "themes": 8, "extras": 26}
KINDS = {".export.CSV.zip": "export", ".mentions.CSV.zip": "mentions", ".gkg.csv.zip": "gkg"}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) a line; quotes mean nothing in these files, so they are text, not CSV."""
    return spark.read.option("lineSep", "\n").text(path)


def manifest(text: DataFrame) -> DataFrame:
    """(kind, size_bytes, md5, url, ts) of "size md5 url" lines; others are passed over."""
    part = F.split(trimmed(F.col("value")), r"\s+")
    kind = F.lit(None).cast("string")
    for suffix, name in KINDS.items():
        kind = F.when(F.col("url").endswith(suffix), name).otherwise(kind)
    rows = text.select(part.alias("p")).filter(F.size("p") == 3).select(number(F.get("p", F.lit(0))).cast("bigint").alias("size_bytes"), F.get("p", F.lit(1)).alias("md5"), F.get("p", F.lit(2)).alias("url"))
    return rows.select(kind.alias("kind"), "size_bytes", "md5", "url", F.nullif(F.regexp_extract("url", r"(\d{14})\.", 1), F.lit("")).alias("ts")).filter("kind is not null and ts is not null")


def event_fields(text: DataFrame) -> DataFrame:
    """Every line that isn't blank, split; keeps other columns, so that a sequence number may ride along."""
    return text.filter(F.col("value") != "").withColumn("f", F.split("value", "\t", -1)).drop("value")


def raw_events(text: DataFrame) -> DataFrame:
    """The 23 projected text fields of lines that have exactly 61."""
    split = event_fields(text).filter(F.size("f") == EVENT_FIELDS)
    others = [c for c in split.columns if c != "f"]
    # Bound as a lambda's variable, a line is split once and not again for each field.  Filters on
    # fields stay above the row number, so that they read the parsed row instead of parsing anew.
    row = F.transform(F.array("f"), lambda f: F.struct(*[F.get(f, F.lit(i)).alias(name) for name, i in EVENT_COLUMNS.items()]))[0]
    parsed = split.select(*others, row.alias("_row"), F.monotonically_increasing_id().alias("_once")).filter("_once >= 0")
    return parsed.select(*others, "_row.*")


def skipped_lines(text: DataFrame) -> DataFrame:
    """(rows, skipped): how many event lines have 61 fields and how many have not."""
    return event_fields(text).agg(F.count_if(F.size("f") == EVENT_FIELDS).alias("rows"), F.count_if(F.size("f") != EVENT_FIELDS).alias("skipped"))


def crisis(themes: Column) -> Column:
    """True if one of "THEME,offset;THEME,offset" is a crisis theme."""
    return F.exists(F.split(F.coalesce(themes, F.lit("")), ";"), lambda t: F.element_at(F.split(t, ","), 1).isin(*C.CRISIS_THEMES))


def page_title(extras: Column) -> Column:
    return F.nullif(F.regexp_extract(extras, "<PAGE_TITLE>([^<]*)</PAGE_TITLE>", 1), F.lit(""))


def article_titles(text: DataFrame, seq: str | None = None) -> DataFrame:
    """(url_canonical, title, source_name, crisis): one row a canonical URL, the last in the file.

    ``seq`` names a column with the order of lines; without it lines are ordered as scanned.
    """
    order = F.col(seq) if seq else F.monotonically_increasing_id()
    f = F.split("value", "\t", -1)
    column = {k: F.get(f, F.lit(i)) for k, i in ARTICLE_COLUMNS.items()}
    rows = text.filter(F.col("value") != "").select(order.alias("seq"), column["url"].alias("url"), page_title(column["extras"]).alias("raw"), F.coalesce(column["source_name"], F.lit("")).alias("source_name"), crisis(column["themes"]).alias("crisis"))
    named = rows.filter("url != '' and raw is not null").withColumn("title", trimmed(decode_entities(F.col("raw")))).filter(F.length("title") >= 8)
    keyed = named.select(canonical_url(F.col("url")).alias("url_canonical"), "title", "source_name", "crisis", "seq")
    return keyed.groupBy("url_canonical").agg(F.max_by(F.struct("title", "source_name", "crisis"), "seq").alias("last")).select("url_canonical", "last.*")


ARTICLE_JSON = "articles array<struct<url:string,title:string,seendate:string,domain:string,language:string,sourcecountry:string>>"


def articles_json(bodies: DataFrame, column: str = "value") -> DataFrame:
    """One row an article of ``{"articles": [...]}`` bodies; a body without the list gives none."""
    found = F.from_json(F.col(column), ARTICLE_JSON)["articles"]
    return bodies.select(F.explode(F.coalesce(found, F.array().cast(ARTICLE_JSON.split(" ", 1)[1]))).alias("a")).select("a.*")


QUOTE = ("symbol", "price", "change_percent", "as_of", "session_state")


def crypto_quote(body: Column) -> Column:
    """A ticker's quote, null where symbol, price or time is missing."""
    v = F.from_json(body, "symbol string, lastPrice string, priceChangePercent string, closeTime bigint")
    quote = F.struct(v["symbol"].alias("symbol"), number(v["lastPrice"]).alias("price"), number(v["priceChangePercent"]).alias("change_percent"), F.timestamp_millis(v["closeTime"]).alias("as_of"), F.lit("continuous").alias("session_state"))
    return F.when((F.coalesce(v["symbol"], F.lit("")) != "") & number(v["lastPrice"]).isNotNull() & v["closeTime"].isNotNull(), quote)


def rate_quote(body: Column, pair: Column) -> Column:
    """A currency pair's daily rate, null for a pair that isn't six letters or has no rate."""
    v, pair = F.from_json(body, "date string, rates map<string,double>"), F.upper(pair)
    price = F.try_element_at(v["rates"], F.substring(pair, 4, 3))
    quote = F.struct(pair.alias("symbol"), price.alias("price"), F.lit(None).cast("double").alias("change_percent"), F.try_to_timestamp(F.concat(v["date"], F.lit("T00:00:00Z"))).alias("as_of"), F.lit("closed").alias("session_state"))
    return F.when((F.length(pair) == 6) & price.isNotNull() & v["date"].isNotNull(), quote)


def energy_quote(body: Column, symbol: Column) -> Column:
    """The newest daily price of a known energy series."""
    v, symbol = F.from_json(body, "response struct<data:array<struct<period:string,value:string>>>"), F.upper(symbol)
    row = F.get(v["response"]["data"], F.lit(0))
    quote = F.struct(symbol.alias("symbol"), number(row["value"]).alias("price"), F.lit(None).cast("double").alias("change_percent"), F.try_to_timestamp(F.concat(row["period"], F.lit("T00:00:00Z"))).alias("as_of"), F.lit("closed").alias("session_state"))
    return F.when(symbol.isin(*C.ENERGY_SERIES) & row["period"].isNotNull() & number(row["value"]).isNotNull(), quote)


def quote_reader(source: str, energy_key: str | None = None):
    """The reader of a source by its id; the energy one only with a key; None for others."""
    if source == "eia" and energy_key is None:
        return None
    return {"binance": lambda body, symbol: crypto_quote(body), "ecb_frankfurter": rate_quote, "eia": energy_quote}.get(source)


MARKET_JSON = "id string, question string, slug string, endDate string, volume string, liquidity string, outcomes string, outcomePrices string, oneDayPriceChange string, closed boolean, active boolean"


def forecast_markets(bodies: DataFrame, column: str = "value") -> DataFrame:
    """Open, priced yes/no questions without banned words, one row each; ``column`` holds one JSON object a row.

    Outcomes and prices may be arrays or strings that hold an array: read as text, both are the same.
    """
    v = F.from_json(F.col(column), MARKET_JSON)
    texts = lambda c: F.from_json(c, "array<string>")
    rows = bodies.select(v.alias("m")).select("m.*").select("*", trimmed(F.coalesce("question", F.lit(""))).alias("q"), texts(F.col("outcomes")).alias("o"), texts(F.col("outcomePrices")).alias("p"))
    small = F.transform("o", F.lower)
    yes = F.array_position(small, "yes").cast("int")
    rows = rows.filter(~F.coalesce("closed", F.lit(False)) & F.coalesce("active", F.lit(True)) & (F.length("q") >= 8) & F.col("slug").isNotNull() & F.col("id").isNotNull())
    rows = rows.filter(~F.col("q").rlike(rf"(?i)\b({'|'.join(C.BANNED_WORDS)})\b")).filter((F.size("o") == 2) & (F.size("p") == 2) & (yes > 0) & (F.get(small, 2 - yes) == "no"))
    priced = rows.withColumn("probability", number(F.get("p", yes - 1))).filter(F.col("probability").between(0, 1))
    return priced.select(F.concat(F.lit("om-"), "id").alias("id"), "slug", F.col("q").alias("question"), F.col("endDate").alias("end_date"), number(F.col("volume")).alias("volume"), number(F.col("liquidity")).alias("liquidity"), "probability", number(F.col("oneDayPriceChange")).alias("prob_change_24h"))


def register(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of a JSON register ``{"<name>": [...]}``."""
    return spark.read.option("multiLine", True).json(path).select(F.explode(name).alias("r")).select("r.*")


#: Lines that a task takes out of an archive at a time.
BLOCK_LINES = 50_000


def archives(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """(path, content, fault) of the zip archives below ``path``, held against a manifest (url, size_bytes, md5) where one is given.

    ``fault`` is null, "not listed", "size" or "md5"; an archive is known by its file name.
    Only faultless ones are worth opening; the others come again with the next fetch.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "length", "content")
    if listed is None:
        return files.select("path", "content", F.lit(None).cast("string").alias("fault"))
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    # The last entry of a name counts, as the newest manifest is read last; ties by digest.
    known = listed.groupBy(name(F.col("url")).alias("name")).agg(F.max(F.struct("size_bytes", "md5")).alias("k"))
    fault = F.when(F.col("k").isNull(), "not listed").when(F.col("length") != F.col("k.size_bytes"), "size").when(F.md5("content") != F.lower("k.md5"), "md5")
    return files.withColumn("name", name(F.col("path"))).join(F.broadcast(known), "name", "left").select("path", "content", fault.alias("fault"))


def unzipped(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """(path, seq, value): the lines of every zip archive below ``path``, of faultless ones only where a manifest is given.

    An archive holds one interval; the task that reads it takes its lines out block by block.
    """

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as stream:
                            text, seq = io.TextIOWrapper(stream, "utf-8", "replace", newline="\n"), 0
                            while block := list(islice(text, BLOCK_LINES)):
                                yield pd.DataFrame({"path": name, "seq": range(seq, seq + len(block)), "value": [x.removesuffix("\n") for x in block]})
                                seq += len(block)

    whole = archives(spark, path, listed).filter("fault is null").select("path", "content")
    return whole.mapInPandas(extract, "path string, seq long, value string")


def complete_intervals(exports: DataFrame, articles: DataFrame, after: str, limit: int = C.MAX_INTERVALS, minutes: int = C.INTERVAL_MINUTES) -> DataFrame:
    """(ts) intervals to process: both files are there, none is left out since ``after``, at most ``limit``.

    The first gap ends the run, so nothing is skipped for good.
    """
    both = exports.select("ts").distinct().join(articles.select("ts").distinct(), "ts").filter(F.col("ts") > after)
    seconds = F.unix_seconds(F.to_timestamp("ts", "yyyyMMddHHmmss"))
    start = F.unix_seconds(F.to_timestamp(F.lit(after), "yyyyMMddHHmmss"))
    # Position by distance: a row is in the unbroken run if as many rows as steps precede it.
    nth = F.row_number().over(W.orderBy("ts"))
    soon = both.filter(seconds <= start + limit * minutes * 60)
    return soon.withColumn("nth", nth).filter(seconds == start + F.col("nth") * minutes * 60).select("ts").orderBy("ts")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
