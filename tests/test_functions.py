"""Column expressions against their defined values."""

import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import constants as C
from tidewatch.functions import scores, text, urls, values


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast("array<string>").alias(k) for k, v in cols.items()])
    return df.select(expr.alias("x")).first()["x"]


def fnv64(s):
    h = 0xCBF29CE484222325
    for c in s:
        h = ((h ^ ord(c)) * 0x100000001B3) & (1 << 64) - 1
    return h


def plain_simhash(tokens):
    grams = [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] if len(tokens) >= 3 else [" ".join(tokens)] if tokens else []
    votes = [sum(1 if fnv64(g) >> b & 1 else -1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if votes[b] > 0)


URLS = [
    ("https://www.Example.com/a/?utm_source=x&b=2&a=1#frag", "https://example.com/a?a=1&b=2"),
    ("https://example.com/", "https://example.com/"),
    ("https://example.com", "https://example.com/"),
    ("http://example.com:80/x/", "http://example.com/x"),
    ("  https://example.com/x?ref=1&reference=2&q=a b ", "https://example.com/x?q=a+b"),
    ("https://example.com/x?b=2&b=1&A=3", "https://example.com/x?A=3&b=2&b=1"),
    ("not a url", "not a url"),
    ("https://e.com/p?x=%zz", "https://e.com/p?x=%25zz"),
]


@pytest.mark.parametrize("raw,want", URLS)
def test_canonical_url(spark, raw, want):
    assert one(spark, urls.canonical_url(F.col("u")), u=raw) == want


def test_url_hash_and_host(spark):
    h = 2166136261
    for c in "https://example.com/":
        h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
    assert one(spark, urls.url_hash(F.col("u")), u="https://www.example.com") == f"{h:08x}"
    assert one(spark, urls.host_of(F.col("u")), u="https://www.news.example.com:8080/x") == "news.example.com"
    assert one(spark, urls.host_of(F.col("u")), u="nothing") is None
    assert one(spark, urls.quote_url(F.col("s"), F.col("e")), s="MAERSK-B", e="CPH").endswith("/MAERSK-B:CPH")


TITLES = ["Navy's war-risk warning in the Red Sea - Reuters", "Iran-backed group strikes | AP", "", "One", "Two words", "The and of", "A much longer headline about talks between two states in Geneva"]


@pytest.mark.parametrize("title", TITLES)
def test_simhash(spark, title):
    tokens = one(spark, text.title_tokens(F.col("t")), t=title)
    assert int(one(spark, text.simhash_hex(text.title_simhash(F.col("t"))), t=title), 16) == plain_simhash(tokens)


def test_title_tokens(spark):
    assert one(spark, text.title_tokens(F.col("t")), t=TITLES[0]) == ["navys", "war", "risk", "warning", "red", "sea"]
    assert one(spark, text.shingles(text.title_tokens(F.col("t"))), t="alpha beta") == ["alpha beta"]
    assert one(spark, text.shingles(text.title_tokens(F.col("t"))), t="") == []


@pytest.mark.parametrize(
    "title,want",
    [
        ("Taiwan Strait sees new patrols by Japan", ["japan", "taiwan strait"]),
        ("Military activity reported", []),
        ("The Hague Court meets in Geneva", ["geneva", "hague court"]),
        ("talks with U.S. Navy", ["us navy"]),
        ("", []),
    ],
)
def test_entities(spark, title, want):
    assert one(spark, text.capital_entities(F.col("t")), t=title) == want


@pytest.mark.parametrize("raw,want", [("&amp;lt;b&#x41;&#66;&#0;", "<bAB"), ("&#128512; &quot;x&apos;", '\U0001f600 "x\''), ("plain", "plain"), ("&#99999999999999999;x", "x")])
def test_decode_entities(spark, raw, want):
    assert one(spark, text.decode_entities(F.col("t")), t=raw) == want


def test_sets_and_slug(spark):
    assert one(spark, text.jaccard(F.col("a"), F.col("b")), a=["x", "y"], b=["y", "z"]) == pytest.approx(1 / 3)
    assert one(spark, text.jaccard(F.col("a"), F.col("b")), a=[], b=[]) == 0.0
    assert one(spark, text.slug(F.col("t"), F.col("k")), t="Hello, World!", k="id").startswith("hello-world-")
    assert one(spark, text.slug(F.col("t"), F.col("k")), t="!!", k="id").startswith("situation-")


@pytest.mark.parametrize("raw,want", [("1.5", 1.5), ("", None), (" ", None), ("1.0d", None), ("Infinity", None), ("NaN", None), ("-3e2", -300.0), (".5", 0.5)])
def test_number(spark, raw, want):
    assert one(spark, values.number(F.col("t")), t=raw) == want


def test_times(spark):
    assert one(spark, values.day_iso(F.col("t")), t="20261320") == "2026-13-20T00:00:00Z"
    assert one(spark, values.day_iso(F.col("t")), t="2026") is None
    assert one(spark, values.moment_iso(F.col("t")), t="20260920130000") == "2026-09-20T13:00:00Z"
    assert one(spark, values.seen_iso(F.col("t")), t="20260920T130000Z") == "2026-09-20T13:00:00Z"
    assert one(spark, values.interval_start(F.to_timestamp(F.col("t"))), t="2026-09-20 13:14:59") == "20260920130000"
    assert one(spark, values.is_ingest_tick(F.to_timestamp(F.col("t"))), t="2026-09-20 13:16:00") is True
    for raw, want in (("0", 7.0), ("x", 7.0), ("90", 30.0), ("-4", 1.0), ("3", 3.0)):
        assert one(spark, values.clamped_days(F.col("t")), t=raw) == want


def test_severity_and_scores(spark):
    sev = scores.severity(F.col("g"), F.col("r"), F.col("q"))
    assert one(spark, sev, g=-10.0, r="19", q=4) == pytest.approx(1.0)
    assert one(spark, sev, g=-10.0, r="99", q=4) == 0.0
    assert one(spark, scores.root_category(F.col("r")), r="1") == "diplomaticNegotiation"
    assert one(spark, scores.root_category(F.col("r")), r="190") is None
    weights = scores.available_weights()
    assert weights["newsVelocity"] == pytest.approx(1 / 3) and sum(weights.values()) == pytest.approx(1)
    total = scores.combined({k: F.lit(v) for k, v in (("newsVelocity", 1.0), ("sourceConfirmation", 0.5), ("severity", 0.5), ("marketMovement", 0.0), ("outlookMovement", 0.5))})
    assert one(spark, total, z=0) == pytest.approx(0.55)
    t0, t1 = F.to_timestamp(F.lit("2026-01-01 00:00:00")), F.to_timestamp(F.lit("2026-01-11 00:00:00"))
    assert one(spark, scores.decayed(F.lit(8.0), t0, t1, F.lit("warArmedConflict")), z=0) == pytest.approx(4.0)
    assert one(spark, scores.decayed(F.lit(8.0), t1, t0, F.lit("warArmedConflict")), z=0) == pytest.approx(8.0)


def test_geo_and_similarity(spark):
    km = one(spark, scores.haversine_km(F.lit(25.03), F.lit(121.56), F.lit(39.9), F.lit(116.4)), z=0)
    assert 1500 < km < 1900
    assert one(spark, scores.category_compat(F.lit("warArmedConflict"), F.lit("militaryMovement")), z=0) == 0.5
    assert one(spark, scores.category_compat(F.lit("warArmedConflict"), F.lit("fiscalPolicy")), z=0) == 0.1
    located = scores.similarity(F.lit(1.0), F.lit(0.0), F.lit(1.0), F.lit(1.0), F.lit(False))
    assert one(spark, located, z=0) == pytest.approx(1.0)
    assert set(C.HALF_LIFE) == set(C.CATEGORIES) == set(C.PILLAR)


def test_relevance_and_signature(spark):
    rel = scores.relevant(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    assert one(spark, rel, a="IRNGOV", b="", c="", d="") is True
    assert one(spark, rel, a="US", b="", c="USA", d="USA") is False
    assert one(spark, rel, a="", b="", c="USA", d="IRN") is True
    sig = scores.entity_signature(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, sig, a="IRN", b="", c="IR") == ["actor:IRN", "geo:IR"]
    assert one(spark, scores.iso_country(F.col("c")), c="ch") == "CN"
    assert math.isclose(one(spark, scores.major_criteria(F.lit(72), F.lit(30), F.lit(2.0), F.lit(16.0)), z=0), 2)
