"""Operators on small frames with known results."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import constants as C
from tidewatch.operators import alerts, calibrate, cluster, dedupe, graph, links, quotes, ranking
from tidewatch.sources import feeds, schemas, store

T0 = datetime(2026, 9, 20, 13)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["id"]: r["root"] for r in found.collect()} == root


def grouped(spark, rows):
    df = spark.createDataFrame([(i, u, t, T0 + timedelta(hours=h)) for i, u, t, h in rows], "id string, url_canonical string, title string, published_at timestamp")
    return {r["id"]: r["canonical_id"] for r in dedupe.duplicate_groups(df).collect()}


def test_dedupe(spark):
    story = "Iran strikes tanker near Hormuz strait"
    found = grouped(
        spark,
        [
            ("b", "https://one.com/a", story, 1), ("a", "https://two.com/b", story + " - Reuters", 2), ("c", "https://three.com/c", "Bakery wins award", 1),
            ("d", "https://www.three.com/c/?utm_source=x", "Quite another headline", 90), ("e", "https://four.com/x", story, 24 * 7),
        ],
    )
    assert found == {"a": "b", "b": "b", "c": "c", "d": "c", "e": "e"}


def test_dedupe_transitive(spark):
    found = grouped(
        spark,
        [("a", "u:a", "red green blue yellow pink", 0), ("b", "u:b", "green blue yellow pink orange", 5), ("c", "u:c", "blue yellow pink orange violet", 10), ("z", "u:z", "", 0)],
    )
    assert found == {"a": "a", "b": "a", "c": "a", "z": "z"}


def test_dedupe_against_all_pairs(spark):
    """Blocking loses no pair of a full comparison."""
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)] + ["Geneva", "Suez", "Lima"]
    rows = [(f"{i:03}", f"u:{i}", " ".join(rng.choices(vocab, k=rng.randint(1, 7))), rng.randint(0, 30)) for i in range(70)]
    df = spark.createDataFrame([(i, u, t, T0 + timedelta(hours=h)) for i, u, t, h in rows], "id string, url_canonical string, title string, published_at timestamp")
    f = {r["id"]: (set(r["tokens"]), set(r["names"]), r["published_at"]) for r in dedupe.featured(df).collect()}
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    want = set()
    for a in f:
        for b in f:
            near = abs((f[a][2] - f[b][2]).total_seconds()) <= 6 * 3600
            j = jac(f[a][0], f[b][0])
            if a < b and near and (j >= C.DUP_JACCARD or (j >= C.DUP_WEAK_JACCARD and jac(f[a][1], f[b][1]) >= C.DUP_ENTITY)):
                want.add((a, b))
    assert {tuple(r) for r in dedupe.duplicate_pairs(df).collect()} == want and want


def test_capped(spark):
    rng = random.Random(3)
    data = [(f"s{i:03}", rng.choice("ABCD") if rng.random() < 0.8 else None, float(rng.randint(0, 20))) for i in range(120)]
    taken, per = [], {}
    for key, country, score in sorted(data, key=lambda r: (-r[2], r[0])):
        own = country or key
        if len(taken) < 10 and per.get(own, 0) < 2:
            per[own] = per.get(own, 0) + 1
            taken.append(key)
    df = spark.createDataFrame(data, "id string, country string, score double")
    assert [r["id"] for r in ranking.capped(df, "score", "id", "country").orderBy("rank").collect()] == taken


def situation(i, **over):
    base = {"id": f"s{i}", "slug": f"slug{i}", "title": "Clash near Hormuz", "category": "warArmedConflict", "lat": 25.0, "lon": 55.0, "country_iso": f"C{i}", "status": "active", "first_seen_at": T0, "last_event_at": T0, "trending_score": 1.0 + i, "peak_score": 0.0, "event_count": 1, "source_count": 3}
    return base | over


def frame(spark, name, rows):
    schema = schemas.TABLES[name].schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def test_ranking_tick(spark):
    now = T0 + timedelta(hours=240)
    rows = frame(spark, "situations", [situation(1), situation(2, last_event_at=now, source_count=2), situation(3, last_event_at=now, score_updated_at=T0), situation(4, last_event_at=T0 - timedelta(days=9)), situation(5, status="recent", last_event_at=now - timedelta(days=15), map_rank=4)])
    found = {r["id"]: r for r in ranking.ranked(rows, F.lit(now)).collect()}
    assert [found[f"s{i}"]["status"] for i in range(1, 6)] == ["recent", "active", "active", "archived", "archived"]
    assert found["s3"]["map_rank"] == 1 and found["s3"]["trending_score"] == pytest.approx(2.0)
    assert found["s2"]["trending_score"] == 3.0 and found["s2"]["map_rank"] is None and found["s5"]["map_rank"] is None


def test_thinned(spark):
    df = spark.range(300).select(F.lit("k").alias("k"), F.col("id"))
    kept = [r["id"] for r in quotes.thinned_rows(df, "k", ["id"]).orderBy("id").collect()]
    want = [int(i * 299 / 95 + 0.5) for i in range(96)]
    assert kept == want and kept[0] == 0 and kept[-1] == 299
    arr = df.agg(quotes.thinned(F.array_sort(F.collect_list("id"))).alias("p")).first()["p"]
    assert arr == want
    for n in (1, 95, 96, 97, 191):
        got = spark.range(n).select(F.lit("k").alias("k"), F.col("id"))
        assert quotes.thinned_rows(got, "k", ["id"]).count() == min(n, 96)


def test_links(spark):
    df = spark.createDataFrame(
        [("a", "warArmedConflict", "Strike near HORMUZ", None), ("b", "fiscalPolicy", "Budget near Hormuz", None), ("c", "sanctionsTradeRestriction", "Talks", "Taipei, Taiwan"), ("d", "earthquakeTsunami", "Quake", "Lima")],
        "id string, category string, title string, geo_name string",
    )
    assets = {}
    for r in links.asset_links(df).orderBy("id", "nth").collect():
        assets.setdefault(r["id"], []).append((r["rule_id"], r["symbol"]))
    assert assets["a"] == [("oil_chokepoint", "BRENT"), ("oil_chokepoint", "WTI"), ("safe_haven_conflict", "PAXGUSDT"), ("safe_haven_conflict", "USDJPY")]
    assert [s for _, s in assets["b"]] == ["EURUSD", "GBPUSD", "USDJPY", "PAXGUSDT"] and "d" not in assets
    firms = links.company_links(df).collect()
    assert sorted(r["symbol"] for r in firms if r["id"] == "c") == ["INTC", "NVDA", "TSM"]
    assert max(r["nth"] for r in firms if r["id"] == "a") == 12


def test_outlook_links(spark):
    s = spark.createDataFrame([("s", "Ceasefire talks resume Geneva", "warArmedConflict")], "id string, title string, category string")
    m = spark.createDataFrame([("m1", "Will ceasefire talks resume Geneva before July", None), ("m2", "Ceasefire talks Paris summit", "warArmedConflict"), ("m3", "resume talks ceasefire lisbon porto", "warArmedConflict"), ("m4", "nothing shared", "warArmedConflict")], "id string, question_normalised string, category string")
    found = {r["market_id"]: (r["confidence"], r["matched_by"]) for r in links.outlook_links(s, m).collect()}
    assert found == {"m1": (pytest.approx(0.8), "token"), "m3": (pytest.approx(0.8), "category")}


def test_alert_rules(spark):
    cases = [("gt", 5.0, None, True), ("gt", 4.0, None, False), ("gte", 4.0, None, True), ("lt", 3.0, None, True), ("lte", 4.0, None, True), ("crosses", 5.0, None, False), ("crosses", 4.0, 3.0, True), ("crosses", 5.0, 4.0, False), ("crosses", 3.0, 5.0, True)]
    df = spark.createDataFrame([(o, c, p) for o, c, p, _ in cases], "o string, c double, p double")
    assert [r["x"] for r in df.select(alerts.triggered(F.col("o"), F.lit(4.0), F.col("c"), F.col("p")).alias("x")).collect()] == [w for *_, w in cases]


def test_merge(spark):
    sig = lambda *xs: list(xs)
    df = spark.createDataFrame([("a", "warArmedConflict", 10.0, 10.0, T0, 1, 2, sig("x", "y")), ("b", "warArmedConflict", 12.0, 10.0, T0 + timedelta(hours=1), 3, 5, sig("x", "y")), ("c", "fiscalPolicy", -50.0, 90.0, T0, 1, 1, sig("x"))], "id string, category string, lat double, lon double, at timestamp, event_count long, source_count long, signature array<string>")
    assert [(r["a"], r["b"]) for r in cluster.merge_candidates(df).collect()] == [("a", "b")]
    m = df.alias("p").filter("p.id = 'a'").join(df.alias("q").filter("q.id = 'b'")).select(*cluster.merged("p", "q")).first()
    assert (m["lat"], m["event_count"], m["source_count"], m["at"]) == (11.5, 4, 5, T0 + timedelta(hours=1))


def test_grid(spark):
    assert calibrate.simplex(spark, 0.5).count() == 15 and calibrate.simplex(spark).count() == 10626
    ex = spark.createDataFrame([(0, 0.0, 1.0, 0.0, 0.0, 0.0, 3), (1, 1.0, 0.0, 0.0, 0.0, 0.0, 0), (2, 0.0, 0.5, 0.0, 0.0, 0.0, 1)], f"seq long, {', '.join(f'{c} double' for c in calibrate.COMPONENTS)}, relevance int")
    best = calibrate.grid_search(ex, 3, 0.5).first()
    assert best["ndcg"] == pytest.approx(1.0) and best["newsVelocity"] == 0.0


def test_feeds(spark):
    lines = spark.createDataFrame([("54071 aa http://x/20260920130000.export.CSV.zip",), ("  1 bb http://x/20260920130000.gkg.csv.zip  ",), ("broken",), ("1 2 http://x/none.txt",)], "value string")
    assert sorted((r["kind"], r["size_bytes"], r["ts"]) for r in feeds.manifest(lines).collect()) == [("export", 54071, "20260920130000"), ("gkg", 1, "20260920130000")]
    bodies = spark.createDataFrame([('{"articles":[{"url":"u","title":"t","seendate":"20260920T130000Z"}]}',), ("{}",), ("junk",)], "value string")
    assert feeds.articles_json(bodies).count() == 1
    q = spark.createDataFrame([('{"symbol":"BTCUSDT","lastPrice":"10.5","priceChangePercent":"x","closeTime":0}', '{"date":"2026-01-02","rates":{"USD":1.1}}', '{"response":{"data":[{"period":"2026-01-02","value":"70.1"}]}}')], "a string, b string, c string")
    r = q.select(feeds.crypto_quote(F.col("a")).alias("a"), feeds.rate_quote(F.col("b"), F.lit("eurusd")).alias("b"), feeds.energy_quote(F.col("c"), F.lit("wti")).alias("c"), feeds.crypto_quote(F.lit("{}")).alias("d"), feeds.rate_quote(F.col("b"), F.lit("eur")).alias("e"), feeds.energy_quote(F.lit("{}"), F.lit("wti")).alias("f")).first()
    assert (r["a"]["price"], r["a"]["change_percent"], r["b"]["symbol"], r["b"]["price"], r["c"]["price"]) == (10.5, None, "EURUSD", 1.1, 70.1)
    assert r["d"] is None and r["e"] is None and r["f"] is None
    assert feeds.quote_reader("eia") is None and feeds.quote_reader("eia", "k") is not None and feeds.quote_reader("x") is None


def test_intervals(spark):
    ts = lambda *xs: spark.createDataFrame([(x,) for x in xs], "ts string")
    both = ["20260920130000", "20260920131500", "20260920133000", "20260920140000"]
    found = feeds.complete_intervals(ts(*both), ts(*both), "20260920124500")
    assert [r["ts"] for r in found.collect()] == both[:3]
    assert feeds.complete_intervals(ts(*both), ts(both[1]), "20260920124500").count() == 0
    assert feeds.complete_intervals(ts(*both), ts(*both), "20260920124500", limit=2).count() == 2


def test_zip_source(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "20260920130000.export.CSV.zip", "w") as z:
        z.writestr("x.CSV", "a\tb\nc")
    found = feeds.unzipped(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["value"] for r in found] == ["a\tb", "c"]


def test_archives_against_a_manifest(spark, tmp_path, monkeypatch):
    """Only archives whose size and digest the manifest has are opened; lines come in blocks."""
    import hashlib
    import zipfile

    monkeypatch.setattr(feeds, "BLOCK_LINES", 3)
    said = []
    for ts, fault in (("20260920130000", None), ("20260920131500", "md5"), ("20260920133000", "size"), ("20260920134500", "not listed")):
        path = tmp_path / f"{ts}.export.CSV.zip"
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("x.CSV", "\n".join(f"{ts} {k}\u2028é" for k in range(8)) + "\n")
        data = path.read_bytes()
        if fault != "not listed":
            said.append(f"{len(data) + (fault == 'size')} {hashlib.md5(data + b'x' * (fault == 'md5')).hexdigest().upper()} http://a.org/{path.name}")
    listed = feeds.manifest(spark.createDataFrame([(x,) for x in said], "value string"))
    assert {r["path"][-29:-15]: r["fault"] for r in feeds.archives(spark, str(tmp_path), listed).collect()} == {"20260920130000": None, "20260920131500": "md5", "20260920133000": "size", "20260920134500": "not listed"}
    found = feeds.unzipped(spark, str(tmp_path), listed).orderBy("seq").collect()
    assert [(r["seq"], r["value"]) for r in found] == [(k, f"20260920130000 {k}\u2028é") for k in range(8)]
    assert feeds.unzipped(spark, str(tmp_path)).count() == 32


def test_violations(spark):
    bad = frame(spark, "situations", [situation(1), situation(2, slug="slug1")]).withColumn("status", F.lit("odd"))
    faults = sorted(r["fault"] for r in schemas.violations(bad, "situations").collect())
    assert faults == ["slug is not unique", "status is not allowed", "status is not allowed"]
    assert len(schemas.TABLES) == 21


def test_store(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"))
    control = lambda region, on: spark.createDataFrame([(region, on, None, T0)], schemas.TABLES["outlook_controls"].schema)
    s.write("outlook_controls", control("US", True))
    s.write("outlook_controls", store.upsert(s.read("outlook_controls"), control("US", False).union(control("GB", True)), ("region_iso",)))
    assert sorted((r["region_iso"], r["is_enabled"]) for r in s.read("outlook_controls").collect()) == [("GB", True), ("US", False)]
    s.write("outlook_controls", s.read("outlook_controls"))
    assert s.vacuum("outlook_controls", 1) == 2 and s.read("outlook_controls").count() == 2
    assert s.read("devices").count() == 0


def _files(root, name):
    return {p: p.stat().st_size for p in (root / name).rglob("*.parquet")}


def test_changes_are_small(spark, tmp_path):
    """One device's change writes and reads one bucket; changes merge in order, and many of them into one part."""
    s, n = store.Store(spark, str(tmp_path)), 2000
    devices = frame(spark, "devices", [{"id": f"d{k}", "apns_token": f"t{k}", "is_pro": False, "created_at": T0, "last_seen_at": T0} for k in range(n)])
    s.write("devices", devices)
    before = _files(tmp_path, "devices")
    one = s.read("devices", of="d7")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(in_folder" in one._jdf.queryExecution().toString() and len(one.inputFiles()) <= len(before)
    s.change("devices", one.withColumn("apns_token", F.lit("new")), gone=s.read("devices", of="d8"))
    added = _files(tmp_path, "devices").keys() - before.keys()
    assert len({p.parent.name for p in added}) <= 2 and sum(p.stat().st_size for p in added) < sum(before.values()) / 4
    rows = {r["id"]: r["apns_token"] for r in s.read("devices").collect()}
    assert len(rows) == n - 1 and rows["d7"] == "new" and "d8" not in rows and rows["d9"] == "t9"
    assert s.read("devices", of="d8").count() == 0 and s.read("devices", of="d7").first()["apns_token"] == "new"
    s.append("devices", devices.filter("id = 'd8'"))  # after it was gone
    s.change("devices", devices.filter("id = 'd7'"))
    assert s.read("devices").count() == n and s.read("devices", of="d7").first()["apns_token"] == "t7"
    s.write("devices", s.read("devices"))
    assert s.version("devices")["changes"] == [] and s.read("devices").exceptAll(devices).count() == 0


def test_parts_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "PARTS", 3)
    s = store.Store(spark, str(tmp_path))
    control = lambda region, on: spark.createDataFrame([(region, on, None, T0)], schemas.TABLES["outlook_controls"].schema)
    for k in range(6):
        s.change("outlook_controls", control(f"R{k % 4}", k % 2 == 0), gone=control("R1", True) if k == 4 else None)
        assert len(s.version("outlook_controls")["parts"]) <= 3
    assert sorted((r["region_iso"], r["is_enabled"]) for r in s.read("outlook_controls").collect()) == [("R0", True), ("R1", False), ("R2", True), ("R3", False)]


def test_days(spark, tmp_path):
    """A range of time reads its days, and what is too old goes without a file written."""
    s = store.Store(spark, str(tmp_path))
    price = lambda h, p: {"asset_id": "a", "ts": T0 - timedelta(hours=h), "price": p, "as_of": T0, "session_state": "open"}
    s.write("asset_prices", frame(spark, "asset_prices", [price(12 * k, float(k)) for k in range(40)]))
    files = _files(tmp_path, "asset_prices")
    some = s.read("asset_prices", since=F.lit(T0 - timedelta(days=3)))
    assert some.count() == 7 and "PartitionFilters: [isnotnull(in_folder" in some._jdf.queryExecution().toString()
    s.drop_before("asset_prices", str(T0 - timedelta(days=2)))
    assert s.read("asset_prices").count() == 5 and _files(tmp_path, "asset_prices") == files
    s.change("asset_prices", frame(spark, "asset_prices", [price(24, 9.0), price(24 * 9, 1.0)]))
    assert sorted(r["price"] for r in s.read("asset_prices").collect()) == [0.0, 1.0, 3.0, 4.0, 9.0]
    s.drop_before("asset_prices", str(T0 - timedelta(days=5)))  # the bound never goes back
    assert s.read("asset_prices").count() == 5


@pytest.mark.parametrize("hubs", [4, 2000])
def test_components_of_stars(spark, monkeypatch, hubs):
    """Hubs, repeated edges, chains across partitions and lone nodes, by union-find over all edges."""
    monkeypatch.setattr(graph, "HUBS", hubs)
    monkeypatch.setattr(graph, "UNITED", 50)
    rng = random.Random(6)
    edges = [(0, k) for k in range(1, 400)] + [(5000, k) for k in range(5001, 5200)] * 2 + [(k, k + 1) for k in range(6000, 6060)] + [(rng.randrange(7000, 7300), rng.randrange(7000, 7300)) for _ in range(140)] + [(9, 9), (8000, 8000), (399, 5100)]
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        above[b] = a
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 1)], "a long, b long").repartition(6)
    assert {r["id"]: r["root"] for r in graph.components(df).collect()} == {x: root(x) for x in list(above)}
    kept = graph.forest(df.filter("a is not null").coalesce(1))
    assert kept.count() <= len(edges)
    assert graph.components(df.limit(0)).count() == 0


def test_delivery_key_writes_small_values_without_an_exponent(spark):
    said = {0.25: "0.250000000000000", 0.0: "0.00000000000000", 1e-4: "0.000100000000000000", 5e-5: "0.0000500000000000000", -1.25e-6: "-0.00000125000000000000", 1234.5: "1234.50000000000"}
    rows = spark.createDataFrame([(v,) for v in said], "v double").select("v", alerts.delivery_key(F.lit("al1"), F.lit("t"), F.col("v")).alias("k"))
    assert {r["v"]: r["k"] for r in rows.collect()} == {v: hashlib.sha256(f"al1|t|{text}".encode()).hexdigest() for v, text in said.items()}


def test_equal_titles_meet_as_one(spark, monkeypatch):
    """Sixty situations and sixty questions of two kinds each: every link comes out, and kinds alone are compared."""
    met, saved = [], links.saved
    monkeypatch.setattr(links, "saved", lambda df: met.append(saved(df)) or met[-1])
    said = ("Tanker near Hormuz", "Quake hits northern coast")
    s = spark.createDataFrame([(f"s{n}", said[n % 2], "energy") for n in range(60)], "id string, title string, category string")
    m = spark.createDataFrame([(f"m{n}", said[n % 2] + " now", None) for n in range(60)], "id string, question_normalised string, category string")
    found = {(r["situation_id"], r["market_id"]) for r in links.outlook_links(s, m).collect()}
    assert found == {(f"s{a}", f"m{b}") for a in range(60) for b in range(60) if a % 2 == b % 2}
    assert max(df.count() for df in met) == 2


def test_delivery_key_rounds_the_number_not_its_shortest_text(spark):
    """Sixteen digits that end in a five, the number itself below the middle: SQL and toPrecision round down."""
    said = {3.073211178125135: "3.07321117812513", 6.275265885374805: "6.27526588537480", 0.0005644468332401975: "0.000564446833240197", 9.014274576114835e-07: "0.000000901427457611483", -0.0: "0.00000000000000"}
    rows = spark.createDataFrame([(v,) for v in [*said, None]], "v double").select("v", alerts.fifteen_digits(F.col("v")).alias("d"))
    assert {r["v"]: r["d"] for r in rows.collect()} == said | {None: None}


def test_watches_take_their_first_hits_without_meeting_all_of_them(spark):
    """Against all pairs, where the first hits of some devices were all sent and times and ids are in different order; pairs looked at stay few."""
    rng = random.Random(5)
    stories = [(f"s{n:04d}", "Tanker near Hormuz", C.CATEGORIES[0], None, "active", 1, T0 + timedelta(hours=rng.randrange(500))) for n in range(600)]
    situations = spark.createDataFrame(stories, "id string, title string, category string, geo_name string, status string, map_rank int, first_seen_at timestamp")
    hit = {(r["id"], "asset", r["symbol"], "") for r in links.asset_links(situations).collect()} | {(r["id"], "company", r["symbol"], r["exchange"]) for r in links.company_links(situations, C.COMPANY_LIMIT_WATCH).collect()}
    keys = sorted({k[1:] for k in hit})
    watches = [(f"d{n}", *keys[(n + i) % len(keys)], T0 + timedelta(hours=rng.randrange(520))) for n in range(200) for i in range(min(2, len(keys)))]
    seen = {s[0]: s[-1] for s in stories}
    pairs = [(d, k, s, e, i) for d, k, s, e, at in watches for i, *key in hit if [k, s, e] == key and seen[i] >= at]
    sent = {p for p in pairs if p[0] in ("d1", "d2") and p[4] < "s0400" or rng.random() < 0.2}
    want = set()
    for d in {w[0] for w in watches}:
        want |= set(sorted((p[4], *p[:4]) for p in pairs if p[0] == d and p not in sent)[: C.MAX_PUSHES])
    schema = "device_id string, kind string, symbol string, exchange string"
    table, devices = spark.createDataFrame(sorted(sent), f"{schema}, situation_id string"), spark.createDataFrame([(f"d{n}", "t") for n in range(200)], "id string, apns_token string")
    looked = []

    def unsent(rows):
        looked.append(rows.count())
        return rows.join(table, table.columns, "left_anti")

    watched = spark.createDataFrame(watches, f"{schema}, created_at timestamp")
    for delivered in (unsent, table):
        found = alerts.watch_impacts(watched, devices, situations, delivered)
        assert {(r["situation_id"], *(r[c] for c in schema.replace(" string", "").split(", "))) for r in found.collect()} == want
    assert len(looked) > 1 and looked[0] <= len(watches) * 2 * C.MAX_PUSHES and sum(looked) * 10 < len(pairs)


def test_best_situation_meets_by_pairs_of_words_and_wide_sets_by_single_ones(spark, monkeypatch):
    """Against all pairs; equal scores of nine decimals go to the smaller id; narrow sets alone never meet by single words."""
    from tidewatch.operators.fold import Story

    rng = random.Random(9)
    words = [f"w{k}" for k in range(40)]
    kinds = ("warArmedConflict", "militaryMovement", "centralBankDecision")
    schema = "id string, lat double, lon double, category string, at timestamp, signature array<string>, tokens array<string>"
    row = lambda name, n: (name, None if rng.random() < 0.1 and name[0] == "e" else rng.choice([0.0, 1.5, 40.0]), rng.choice([0.0, 2.0]), rng.choice(kinds), T0 + timedelta(hours=rng.randrange(40)), rng.sample("abcdef", rng.randrange(4)), rng.sample(words, n))
    events, narrow = [row(f"e{k}", rng.randrange(0, 6)) for k in range(80)], [row(f"s{k}", rng.randrange(0, 8)) for k in range(60)]
    wide = [row(f"t{k}", 30) for k in range(10)] + [("t99", *narrow[0][1:])]
    micros = lambda r: dict(zip(("id", "lat", "lon", "category", "at", "marks", "words", "sources"), (*r[:4], int((r[4] - T0).total_seconds() * 1e6), r[5], r[6], 1), strict=True))

    def best(situations):
        out = {}
        for e in map(micros, events):
            found = [(-round(Story(s).score(e), 9), s["id"]) for s in map(micros, situations) if len({*e["words"]} & {*s["words"]}) >= 2]
            if found and -min(found)[0] >= C.JOIN_THRESHOLD:
                out[e["id"]] = (min(found)[1], -min(found)[0])
        return out

    found = lambda situations: {r["event_id"]: (r["situation_id"], r["score"]) for r in cluster.best_situation(spark.createDataFrame(events, schema), spark.createDataFrame(situations, schema)).collect()}
    assert found(narrow + wide) == best(narrow + wide) and any(s > "t" for s, _ in best(narrow + wide).values())
    monkeypatch.setattr(cluster, "prefix", None)
    assert found(narrow) == best(narrow)
