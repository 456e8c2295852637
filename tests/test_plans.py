"""Ingestion, serving, alerting and streaming over a store, end to end."""

import json
import os
import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_operators import T0, frame, situation
from tidewatch.functions import constants as C
from tidewatch.operators.normalize import typed_events
from tidewatch.plans import ingest, kept, notify, serve
from tidewatch.sources import feeds, schemas
from tidewatch.sources.store import Store, seed, upsert_links
from tidewatch.streaming import ingest as stream

NOW_AT = T0 + timedelta(minutes=30)
TITLES = ["Iran strikes base near Hormuz strait", "Iran strikes naval base near Hormuz", "Hormuz strait base strikes by Iran continue", "Local bakery wins", "Iran strikes base near Hormuz strait | AP"]


def event(i, url, root="19", goldstein="-10", quad="4", lat="25.0", lon="55.0", added="20260920130000", mentions="100", a1="IRNGOV", geo="IR"):
    f = [""] * feeds.EVENT_FIELDS
    for k, v in {0: str(i), 1: "20260920", 5: a1, 7: "IRN", 15: "USAMIL", 17: "USA", 26: root + "0", 28: root, 29: quad, 30: goldstein, 31: mentions, 32: "5", 33: "5", 34: "-3", 51: "4", 52: "Place", 53: geo, 56: lat, 57: lon, 59: added, 60: url}.items():
        f[k] = v
    return "\t".join(f)


def article(url, title, themes="ARMEDCONFLICT,10", source="Reuters"):
    f = [""] * 27
    for k, v in {1: "20260920130000", 3: source, 4: url, 8: themes, 26: f"<PAGE_TITLE>{title}</PAGE_TITLE>"}.items():
        f[k] = v
    return "\t".join(f)


def lines(spark, *rows):
    return spark.createDataFrame([(n, r) for n, r in enumerate(rows)], "seq long, value string").coalesce(1)


def batch(spark, store, events, articles, rounds=False):
    typed = typed_events(feeds.raw_events(lines(spark, *events))).filter("relevant").drop("relevant")
    return ingest.ingest_batch(store, typed, feeds.article_titles(lines(spark, *articles), "seq"), F.lit(NOW_AT), rounds)


def situations(store):
    return sorted((r["id"], r["title"], r["event_count"], r["source_count"], round(r["trending_score"], 9), r["lat"]) for r in store.read("situations").collect())


FIRST = ([event(i, f"http://www.s{i}.com/n?utm_source=q", mentions=str(50 + i)) for i in range(5)], [article(f"http://s{i}.com/n", t, source=f"src{i}.com") for i, t in enumerate(TITLES)])


def test_ingest_and_replay(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    counts = batch(spark, store, *FIRST)
    assert (counts["events_kept"], counts["situations_created"]) == (5, 2)
    rows = {r["id"]: r for r in store.read("situations").collect()}
    assert set(rows) == {"sit-gdelt-0", "sit-gdelt-3"} and rows["sit-gdelt-0"]["event_count"] == rows["sit-gdelt-0"]["source_count"] == 4
    assert rows["sit-gdelt-0"]["title"] == TITLES[4]  # of the most mentioned event
    before = situations(store)
    again = batch(spark, store, *FIRST)
    assert (again["events_kept"], again["events_already_stored"]) == (0, 5) and situations(store) == before
    assert ingest.ranking_tick(store, F.lit(NOW_AT)) == 1
    # A run that was cut off before aggregation is repaired.
    store.write("situations", store.read("situations").withColumn("event_count", F.lit(0)))
    batch(spark, store, *FIRST)
    assert {r["id"]: r["event_count"] for r in store.read("situations").collect()} == {"sit-gdelt-0": 4, "sit-gdelt-3": 1}
    other = Store(spark, str(tmp_path / "rounds"))
    batch(spark, other, *FIRST, rounds=True)
    assert situations(other) == before


def test_kept_views(spark, tmp_path):
    """After batches that repeat articles, events and stories the kept views are what the stored tables say."""
    rng, store = random.Random(4), Store(spark, str(tmp_path))
    words = ["Iran", "base", "Hormuz", "strait", "naval", "strikes", "port", "tanker", "talks"]
    for _ in range(2):
        pages = {f"http://s{rng.randrange(12)}.com/n": " ".join(rng.sample(words, 5)) for _ in range(9)}
        events = [event(rng.randrange(40), rng.choice(list(pages)), mentions=str(rng.randrange(20, 90)), a1=rng.choice(["IRNGOV", "USAMIL"]), lat=str(25 + rng.random())) for _ in range(14)]
        batch(spark, store, events, [article(u, t, source=f"src{rng.randrange(4)}.com") for u, t in pages.items()])
    found = {name: sorted(map(str, store.read(name).collect())) for name in ("kept_keys", "kept_picks")}
    assert found["kept_keys"] and store.version("kept_keys")["changes"] == []  # keys are only added
    assert found["kept_keys"] == sorted(map(str, kept.keys_of(kept.history(store)).collect()))
    assert found["kept_picks"] == sorted(map(str, kept.picks_of(kept.history(store)).collect()))
    numbers = {r["situation_id"]: (r["article_count"], r["publishers"]) for r in kept.numbers(store, store.read("situation_events")).collect()}
    assert numbers == {r["id"]: (r["event_count"], r["source_count"]) for r in store.read("situations").collect()}


def test_candidates(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    events = [event(1, "http://a.com/x", goldstein="-5"), event(2, "http://www.a.com/x/", goldstein="-9"), event(3, "http://a.com/x", lat=""), event(4, "http://b.com/x", goldstein="9"), event(5, "http://c.com/x"), event(6, "http://d.com/x")]
    articles = [article("http://a.com/x", "First headline of it"), article("http://a.com/x", "Last headline wins here"), article("http://b.com/x", "Mild event headline"), article("http://c.com/x", "No crisis headline", themes="TAX"), article("http://d.com/x", "Short")]
    assert batch(spark, store, events, articles)["events_kept"] == 1
    assert [r["id"] for r in store.read("events").collect()] == ["gdelt-2"]
    assert [r["title"] for r in store.read("articles").collect()] == ["Last headline wins here"]


INTERVALS = ("20260920130000", "20260920131500", "20260920133000")


def test_streams(spark, tmp_path):
    """A late article file delays the stream, which then goes on; catch-up and stream share the mark."""
    e, a = tmp_path / "e", tmp_path / "a"
    e.mkdir()
    a.mkdir()
    heads = lambda k: "\n".join(article(f"http://s{i}.com/{k}", t, source=f"src{i}.com") for i, t in enumerate(TITLES))
    for k, ts in enumerate(INTERVALS):
        (e / f"{ts}.export.CSV").write_text("\n".join([*(event(100 * k + i, f"http://s{i}.com/{k}", added=ts) for i in range(5)), "bad line", ""]))
        if k != 1:
            (a / f"{ts}.gkg.csv").write_text(heads(k))
    two = Store(spark, str(tmp_path / "two"))
    first, now = "20260920124500", F.lit(NOW_AT)

    def start(limit=6):
        done = []
        q = stream.stream(two, str(e), str(a), str(tmp_path / "ck"), first, now, lambda n, counts: done.append(counts["ts"]), limit)
        q.awaitTermination()
        assert q.exception() is None
        return done

    def agreed():
        """The mark, which is also the checkpoint's last offset."""
        last = max((p for p in (tmp_path / "ck/offsets").iterdir() if p.name.isdigit()), key=lambda p: int(p.name)).read_text().splitlines()[-1]
        assert json.loads(last)["interval"] == stream.high_water(two, first)
        return stream.high_water(two, first)

    assert start() == [INTERVALS[0]] and agreed() == INTERVALS[0]
    assert start() == []  # the third is there, the second is not
    (a / f"{INTERVALS[1]}.gkg.csv").write_text(heads(1))
    assert start(limit=1) == [INTERVALS[1]] and agreed() == INTERVALS[1]
    assert [r["ts"] for r in stream.run_pending(two, str(e), str(a), first, now)] == [INTERVALS[2]]
    assert start() == [] and agreed() == INTERVALS[2]  # the catch-up did it
    assert stream.run_pending(two, str(e), str(a), first, now) == [] and len(situations(two)) == 2
    assert two.read("ingest_runs").filter("status = 'success'").count() == 3


@pytest.fixture
def served(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    asset = lambda i, symbol, cls, lic="green": {"id": i, "symbol": symbol, "name": f"Name {symbol}", "class": cls, "currency": "USD", "data_source": "x", "license_class": lic, "is_delayed": False, "delay_minutes": 0}
    price = lambda a, h, p, ch=None: {"asset_id": a, "ts": T0 - timedelta(hours=h), "price": p, "change_pct": ch, "as_of": T0, "session_state": "closed"}
    store.write("assets", frame(spark, "assets", [asset("wti", "WTI", "commodity"), asset("eur", "EURUSD", "fx"), asset("nas", "NASDAQ", "index", "red"), asset("none", "PAXGUSDT", "crypto")]))
    store.write("asset_prices", frame(spark, "asset_prices", [price("wti", 1, 110.0), price("wti", 24, 100.0), price("wti", 24 * 20, 1.0), price("eur", 2, 1.2, 0.5), price("eur", 30, 1.0), price("nas", 1, 5.0)] + [price("wti", 25 + k / 4, 90.0 + k) for k in range(300)]))
    store.write("situations", frame(spark, "situations", [situation(1, map_rank=2), situation(2, map_rank=1, category="earthquakeTsunami", title="Quake"), situation(3, status="archived")]))
    return store


def test_serving(spark, served):
    found = {r["symbol"]: r["quote"] for r in serve.markets(served, F.lit(T0)).collect()}
    assert set(found) == {"WTI", "EURUSD", "PAXGUSDT"} and found["PAXGUSDT"] is None
    assert found["WTI"]["changePercent"] == pytest.approx(10.0) and found["EURUSD"]["changePercent"] == 0.5
    points = {r["symbol"]: r["points"] for r in serve.history(served, F.lit(T0), 90).collect()}
    assert len(points["WTI"]) == C.SERIES_POINTS and points["WTI"][-1]["price"] == 110.0
    now = serve.now_snapshot(served, F.lit(T0)).first()
    assert [s["id"] for s in now["situations"]] == ["s2", "s1"] and [a["symbol"] for a in now["assets"]] == ["EURUSD", "PAXGUSDT", "WTI"]
    text = serve.body(serve.now_snapshot(served, F.lit(T0))).first()
    assert text["body"].startswith('{"schemaVersion":1') and text["etag"].startswith('"')
    assert [r["situationID"] for r in serve.impact(served).collect()] == ["s1"]
    page = serve.situation(served, "s1", F.lit(T0))
    assert [r["symbol"] for r in page["impactedAssets"].collect()] == ["WTI", "PAXGUSDT"] and page["companies"].count() == 12
    assert serve.situation(served, "nothing", F.lit(T0)) is None
    assert {k: v.count() for k, v in serve.search(served, "quake").items()} == {"situations": 1, "assets": 0, "companies": 0}
    assert {k: v.count() for k, v in serve.search(served, "x").items()} == {"situations": 0, "assets": 0, "companies": 0}
    assert serve.search(served, "boe")["companies"].first()["symbol"] == "BA"


def test_outlook(spark, served):
    found = spark.createDataFrame([("om-1", "slug", "Will the clash near Hormuz end", None, 1.0, 1.0, 0.4, None)], "id string, slug string, question string, end_date string, volume double, liquidity double, probability double, prob_change_24h double")
    assert ingest.outlook_run(served, found, F.lit(T0)) == {"stored": 1, "linked": 1}
    ingest.outlook_run(served, found.withColumn("probability", F.lit(0.6)), F.lit(T0 + timedelta(hours=1)))
    m = served.read("outlook_markets").first()
    assert (m["probability"], m["prev_probability"]) == (0.6, 0.4)
    ingest.outlook_run(served, found.withColumn("slug", F.lit("other")).withColumn("id", F.lit("om-2")), F.lit(T0 + timedelta(hours=9)))
    assert {r["slug"]: r["is_resolved"] for r in served.read("outlook_markets").collect()} == {"slug": True, "other": False}
    ingest.set_manual_link(served, "s1", "om-2", False)
    kept = upsert_links(served.read("situation_outlook"), served.read("situation_outlook").withColumns({"confidence": F.lit(0.1), "matched_by": F.lit("token")}))
    assert {r["market_id"]: r["confidence"] for r in kept.collect()} == {"om-1": 0.1, "om-2": 1.0}
    public = serve.public_outlook(served.read("outlook_markets"), served.read("situation_outlook"))
    assert public.count() == 1 and not {"venue", "slug", "url"} & set(public.columns)
    assert ingest.region_enabled(served, None) and ingest.region_enabled(served, "us")
    ingest.set_region(served, "us", False, "x", F.lit(T0))
    assert not ingest.region_enabled(served, "US")


class Recorder:
    """A sender that notes what it took in a file, since it runs in tasks; ``fail`` says which tokens are refused how."""

    def __init__(self, path=None, fail=None, dies_after=None):
        self.path, self.fail, self.tries, self.dies_after = path, fail or {}, 0, dies_after

    def send(self, token, payload):
        self.tries += 1
        if token in self.fail:
            raise self.fail[token]
        with open(self.path, "a") as out:
            out.write(json.dumps([token, payload]) + "\n")
        if self.dies_after is not None and len(self.sent) == self.dies_after:
            os._exit(1)  # the worker is gone between the sending and its receipt

    @property
    def sent(self):
        return [json.loads(x) for x in open(self.path)] if os.path.exists(self.path) else []


def test_alert_tick(spark, served, tmp_path):
    serve.register_device(served, "d1", "t1", "US", F.lit(T0))
    serve.register_device(served, "d2", "t2", None, F.lit(T0))
    rule = lambda i, d, **k: {"id": i, "device_id": d, "kind": "price", "subject_type": "asset", "subject_id": "wti", "operator": "gt", "threshold": 105.0, "live_activity": False, "is_active": True, "cooldown_minutes": 15} | k
    rules = [rule("a", "d1"), rule("b", "d1", operator="crosses"), rule("c", "d1", threshold=200.0), rule("d", "d2", subject_type="situation", subject_id="s1", threshold=1.0), rule("e", "d9"), rule("f", "d1", operator="odd"), rule("g", "d1", subject_id="nas"), rule("h", "d1", threshold=float("nan"))]
    refused = {r["id"]: r["why"] for r in serve.add_alerts(served, frame(spark, "alerts", rules)).collect()}
    assert refused == {"e": "device not found", "f": "unsupported alert kind, subject, or operator", "g": "unknown or unlicensed asset", "h": "invalid alert rule"}
    box = Recorder(tmp_path / "sent")
    assert notify.alert_tick(served, box, F.lit(T0)) == 3 and sorted(p["alert"] for _, p in box.sent) == ["a", "b", "d"]
    assert notify.alert_tick(served, box, F.lit(T0 + timedelta(minutes=5))) == 0  # cooldown
    assert served.read("alert_deliveries").count() == 3
    dead = Recorder(tmp_path / "late", {"t1": notify.SendError(410, "Unregistered")})
    assert notify.alert_tick(served, dead, F.lit(T0 + timedelta(minutes=20)), 0) == 1
    assert [r["id"] for r in served.read("devices").collect()] == ["d2"]
    serve.change_alert(served, "d2", "d", active=False)
    assert serve.device_alerts(served, "d2").first()["isActive"] is False
    serve.drop_alert(served, "d2", "d")
    serve.remove_device(served, "d2")
    assert served.read("devices").count() == serve.device_alerts(served, "d2").count() == 0


def test_sending_again():
    busy = Recorder(fail={"t": notify.SendError(503, "Busy")})
    with pytest.raises(notify.SendError):
        notify.send(busy, "t", {}, 0)
    gone = Recorder(fail={"t": notify.SendError(400, "BadDeviceToken")})
    with pytest.raises(notify.SendError):
        notify.send(gone, "t", {}, 0)
    assert (busy.tries, gone.tries) == (3, 1)


def test_a_worker_that_dies_while_sending(spark, served, tmp_path):
    """Only the group that was open is sent again, by the next tick, and nothing is lost or recorded twice."""
    n, group = 60, notify.GROUP
    served.write("devices", frame(spark, "devices", [{"id": f"d{k}", "apns_token": f"t{k}", "is_pro": False, "created_at": T0, "last_seen_at": T0} for k in range(n)]))
    served.write("alerts", frame(spark, "alerts", [{"id": f"a{k}", "device_id": f"d{k}", "kind": "price", "subject_type": "asset", "subject_id": "wti", "operator": "gt", "threshold": 105.0, "live_activity": False, "is_active": True, "cooldown_minutes": 15} for k in range(n)]))
    box = Recorder(tmp_path / "sent", dies_after=group + 3)
    with pytest.raises(Exception):  # noqa: B017, PT011
        notify.alert_tick(served, box, F.lit(T0), 0)
    assert served.read("alert_deliveries").count() == 0 and len(box.sent) < n
    healed = Recorder(tmp_path / "sent")
    notify.alert_tick(served, healed, F.lit(T0 + timedelta(minutes=1)), 0)
    times = Counter(token for token, _ in healed.sent)
    assert set(times) == {f"t{k}" for k in range(n)} and max(times.values()) <= 2 and sum(times.values()) - n <= group
    done = served.read("alert_deliveries").collect()
    assert {r["alert_id"] for r in done} == {f"a{k}" for k in range(n)} and len(done) == n
    assert {r["fired_at"] for r in done} == {T0, T0 + timedelta(minutes=1)}  # what the first tick has receipts for is of its time
    assert notify.alert_tick(served, healed, F.lit(T0 + timedelta(minutes=2)), 0) == 0


def test_watch_tick(spark, served, tmp_path):
    serve.register_device(served, "d1", "t1", None, F.lit(T0 - timedelta(days=1)))
    watch = lambda *rows: spark.createDataFrame(list(rows), "kind string, symbol string, exchange string")
    five = watch(("company", "XOM", "NYSE"), ("company", "LMT", "NYSE"), ("asset", "WTI", None), ("asset", "BRENT", ""), ("company", "DAL", "NYSE"))
    assert serve.replace_watches(served, "d1", five, F.lit(T0 - timedelta(hours=1))) == 5
    with pytest.raises(ValueError):
        serve.replace_watches(served, "d1", watch(("company", "XOM", "NSE")), F.lit(T0))
    with pytest.raises(LookupError):
        serve.replace_watches(served, "d9", five, F.lit(T0))
    box = Recorder(tmp_path / "sent")
    assert [notify.watch_tick(served, box, F.lit(T0)) for _ in range(3)] == [3, 1, 0]
    serve.replace_watches(served, "d1", watch(("company", "XOM", "NYSE"), ("company", "RTX", "NYSE")), F.lit(T0 + timedelta(hours=1)))
    assert {r["symbol"]: r["created_at"] for r in served.read("device_watches").collect()} == {"XOM": T0 - timedelta(hours=1), "RTX": T0 + timedelta(hours=1)}
    assert notify.watch_tick(served, box, F.lit(T0)) == 0  # the new watch is younger than the situation


def test_quotes_and_seeds(spark, served):
    quotes = spark.createDataFrame([("WTI", 120.0, None, T0, "closed"), ("NASDAQ", 1.0, None, T0, "open")], "symbol string, price double, change_percent double, as_of timestamp, session_state string")
    assert ingest.quote_run(served, quotes, F.lit(T0)) == 1
    assert {r["symbol"]: r["quote"]["price"] for r in serve.markets(served, F.lit(T0)).filter("quote is not null").collect()}["WTI"] == 120.0
    ingest.quote_retention(served, F.lit(T0 + timedelta(days=30)))
    assert served.read("asset_prices").count() == 1
    seed(served, "sources", spark.createDataFrame([("g", "G", "g.org", "api", 1, "green")], "id string, name string, domain string, kind string, credibility_tier int, license_class string"))
    seed(served, "sources", spark.createDataFrame([("g", "H", "g.org", "api", 1, "green")], "id string, name string, domain string, kind string, credibility_tier int, license_class string"))
    assert [r["name"] for r in served.read("sources").collect()] == ["H"]
    assert schemas.violations(served.read("sources"), "sources").count() == 0


def test_receipts_of_many_groups_lie_in_few_files(tmp_path):
    from types import SimpleNamespace

    import pyspark
    from tidewatch.sources import files, push

    class Dead5:
        def send(self, token, payload):
            if token.endswith("5"):
                raise push.SendError(410, "Unregistered")

    rows = [pyspark.sql.Row(key=f"k{n}", device=f"d{n}", token=f"t{n}", payload="{}") for n in range(50 * push.GROUP)]
    was, push.TaskContext = push.TaskContext, SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 7))
    try:
        writer = push.PushWriter(str(tmp_path), Dead5(), 0)
        assert writer.write(iter(rows)).rows == len(rows)
        assert writer.write(iter(rows)).rows == 0  # a second try finds all receipts
    finally:
        push.TaskContext = was
    found = files.listed(f"{tmp_path}/receipts", "p")
    lines = [line for path in found for line in files.read_text(path).splitlines()]
    assert len(found) == 1 and len(lines) == len(rows) and sum(push.GONE in line for line in lines) == len(rows) // 10


def test_batches_are_not_worked_out_twice(spark, monkeypatch):
    """An eager checkpoint runs its plan twice; a batch stores its steps as files, once."""
    from tidewatch.plans import catalogue, stored

    assert stored.FIXTURE

    def twice(self, *_):
        raise AssertionError("checkpoint")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", twice)
    assert catalogue.queries()["stream_ingest"](spark, "/root/testdata/sf0.001").count()
