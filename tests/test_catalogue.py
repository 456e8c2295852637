"""Every catalogue query against its SQL twin in DuckDB, on the smallest tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest

from tidewatch.plans import catalogue, stored

assert stored.FIXTURE  # its queries join the catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert found == rows(names, cursor.fetchall())


def test_article_titles_with_entities(spark, tmp_path):
    heads = ["token = &quot;73ab&quot;", "Bread &amp; butter", "A &amp;quot;B&amp;quot; story", "&amp;amp; and &amp;lt; &lt;", "Caf&#233; &#x41; &#39;it&apos;s", "a &amp;#39; b &amp;#65; c"]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(n, f"https://a.org/{n}", f"<html><title>{h}</title>") for n, h in enumerate(heads)])
    db.execute(f"COPY pages TO '{tmp_path}/pages.parquet'")
    df = catalogue.queries()["feed_article_titles"](spark, str(tmp_path))
    cursor = db.execute(catalogue.oracle_sql()["feed_article_titles"])
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    assert len(want) == len(heads) and rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_alert_tick_with_amounts_of_cents(spark, tmp_path):
    """Scores below 0.0001 are part of what a delivery's digest says."""
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        columns = "* REPLACE (c_custkey % 9 / 100.0 AS c_acctbal)" if path.stem == "customer" else "*"
        db.execute(f"COPY (SELECT {columns} FROM '{path}') TO '{tmp_path}/{path.name}'")
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{tmp_path}/{path.name}'")
    df = catalogue.queries()["alert_tick"](spark, str(tmp_path))
    cursor = db.execute(catalogue.oracle_sql()["alert_tick"])
    names = [d[0] for d in cursor.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())


def test_merge_keys_are_not_broadcast(spark):
    """Keys are many more than the stories that they are guessed from, so no side of their join may go to the driver."""
    plan = catalogue.queries()["merge_candidates"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [key#" in plan and "HashJoin [key#" not in plan


def test_merge_candidates_reads_odd_events_too(spark, tmp_path):
    """Day stories are those of all events, whatever their numbers."""
    db = duckdb.connect()
    db.execute(f"COPY (SELECT 2 * event_id + 1 AS event_id, ts, user_id, event_type, value, props FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet'")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = catalogue.queries()["merge_candidates"](spark, str(tmp_path))
    cursor = db.execute(catalogue.oracle_sql()["merge_candidates"])
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    assert want and rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_merge_keys_are_moved_once_and_no_pair_is_lost(spark, tmp_path):
    """Both sides of the join of keys are one exchange, and what meets at poles, the date line and tiles' edges is what all pairs give."""
    db = duckdb.connect()
    db.execute(f"COPY (SELECT event_id % 1440 AS event_id, ts, user_id % 3 + 400 * (event_id % 30) AS user_id, event_type, value, props FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet'")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = catalogue.queries()["merge_candidates"](spark, str(tmp_path))
    cursor = db.execute(catalogue.oracle_sql()["merge_candidates"])
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    assert len(want) > 100 and rows(df.columns, [tuple(r) for r in df.collect()]) == want
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert "ReusedExchange [key#" in catalogue.queries()["merge_candidates"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", ["best_situation", "merge_candidates"])
def test_loops_over_pairs_are_compiled(spark, capsys, name):
    """The JVM only interprets methods of more than 8,000 bytes of code, some twenty times slower."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        catalogue.queries()[name](spark, SF).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
