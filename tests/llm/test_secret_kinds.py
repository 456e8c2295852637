"""Secrets of the further kinds: whole values, counted by value."""

import hashlib
import random
import string

from pyspark.sql import functions as F

from tidewatch.llm import common, secret_scan


def test_private_keys_are_counted_by_body(spark):
    """Many owners with a key each keep their keys as secrets; a key that all hold is an example."""
    rng = random.Random(2)

    def key(end="\n-----END RSA PRIVATE KEY-----", newline="\n"):
        lines = ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(64)) for _ in range(4)]
        return newline.join(["-----BEGIN RSA PRIVATE KEY-----", *lines, "Ab9="]) + end

    own = [key() for _ in range(6)] + [key(end=""), key(newline="\\n", end="\\n-----END RSA PRIVATE KEY-----")]
    shared = key()
    texts = [f"mine {k} end" for k in own] + [f"secret = {own[0]} end"] + [f"theirs {shared} end"] * 6
    owners = [f"s{i}" for i in range(8)] + ["s0"] + [f"t{i}" for i in range(6)]
    df = spark.createDataFrame([(i, t, "en", s) for i, (t, s) in enumerate(zip(texts, owners, strict=True))], "doc_id long, text string, lang string, source string")
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scanned(df).select("doc_id", secret_scan.listed(F.col("spans")).alias("spans")).collect()}
    assert [spans[i] for i in range(8)] == [f"private:5:{5 + len(k)}" for k in own]
    assert f"private:9:{9 + len(own[0])}" in spans[8].split(",")
    assert all("private" not in spans[i] for i in range(9, 15))
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redacted(df).collect()}
    assert all(clean[i] == f"mine {secret_scan.MASK} end" for i in range(8)) and clean[8] == f"{secret_scan.MASK} end"


def test_mixed_strings_with_a_late_digit():
    """The digit of a mixed string may stand anywhere in it; without one it is no candidate."""
    letters = (string.ascii_letters * 2)[:49]
    assert secret_scan.further_spans(f"x {letters}7ab y", []) == [("mixed", 2, 54)]
    assert secret_scan.further_spans(f"x {letters}qab y", []) == []


def test_rows_without_an_id_are_masked(spark):
    """A live value is masked in rows whose doc_id is null or repeated as well."""
    own = "ghp_" + "Zz9Yy8Xx" * 5
    df = spark.createDataFrame([(None, f"key {own} here", "en", "s1"), (1, "plain", "en", "s1"), (1, f"other {own}", "en", "s1"), (2, None, "en", "s1")], "doc_id long, text string, lang string, source string")
    assert sorted(r["text"] or "" for r in secret_scan.redacted(df).collect()) == sorted(["", "plain", f"key {secret_scan.MASK} here", f"other {secret_scan.MASK}"])


def test_query_against_plain_counts(spark):
    """Base spans and verdicts of every document, by counts in plain Python."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    held = {}
    for r in docs:
        text = r["text"] or ""
        base = secret_scan.base_spans(text)
        held[r["doc_id"]] = r, secret_scan.ordered(base + secret_scan.further_spans(text, base))

    def value(kind, text):
        return secret_scan.ASSIGN.fullmatch(text).group(2) if kind == "assign" else text

    owners, repositories = {}, {}
    for r, spans in held.values():
        for k, s, e in spans:
            v = value(k, r["text"][s:e])
            owners.setdefault(v, set()).add(r["source"])
            repositories.setdefault(v, set()).add((r["source"], r["lang"]))
    line, n_copied = (lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)), 0
    found = {r["doc_id"]: r for r in secret_scan.query(spark, "/root/testdata/sf0.1").collect()}
    assert found.keys() == held.keys()
    for i, (r, spans) in held.items():
        live = [x for x in spans if len(owners[v := value(x[0], r["text"][x[1] : x[2]])]) <= 2 and len(repositories[v]) <= 4]
        copied = [x for x in spans if x not in live]
        base = [x for x in spans if x[0] in secret_scan.BASE]
        n_copied += len(copied)
        got = found[i]
        assert [got[f"n_{k}"] for k in secret_scan.BASE] == [sum(x[0] == k for x in spans) for k in secret_scan.BASE]
        assert got["base_sha256"] == hashlib.sha256(line(base).encode()).hexdigest()
        assert (got["spans"], got["live"], got["copied"]) == (line(x for x in spans if x in base or x in live), line(live), line(copied))
    assert n_copied >= 2


def test_hot_values_meet_by_broadcast(spark, monkeypatch):
    """The same verdicts whether all values are hot, some, or none."""
    texts = [f"password = example1 and token: own{i:04d}x" for i in range(40)]
    df = spark.createDataFrame([(i, t, "en", f"s{i % 5}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for share in (1, 20, 10_000):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        rows = {r["doc_id"]: r for r in secret_scan.scanned(df).collect()}
        assert all([s["start"] for s in r["live"]] == [24] and [s["start"] for s in r["copied"]] == [0] and len(r["spans"]) == 2 for r in rows.values()) and len(rows) == 40
