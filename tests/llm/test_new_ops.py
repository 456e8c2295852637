"""Spelling groups, the filter audit and line dedup against plain computations, on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import filter_audit, line_dedup, spelling
from tidewatch.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_lines long, mark int, _lost string, rank int, good int"
HELD = "  The same notice stands in many of these files. "
LINES = [
    (1, f"{HELD}\nown line of the first document\n\n{HELD.strip().upper()}"), (2, f"{HELD}\n\tshort"), (3, HELD.strip() + "\n"), (4, None), (5, ""), (6, "\n\n"), (7, f"a\n{HELD}\r\nb"),
    (8, "É" * 19 + "\n" + "É" * 20), (9, "É" * 19 + "\n" + "É" * 20), (10, "É" * 20 + "\n" + "É" * 19), (11, "é" * 20), (None, HELD), (None, HELD), (3, HELD.strip() + "\n"), (3, "another text of document three\n" + HELD),
    (12, "twice is not often enough here\n" * 3), (13, "twice is not often enough here"), (13, "twice is not often enough here"), (14, ("a line that stands in long texts\n" * 4000)), (15, "A LINE that stands in long texts"), (16, "a line that stands in long texts "),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 7, 8, "x", 9, 1) for i, t in rows], SCHEMA)


def plain_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20 and i is not None:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if i is None or len(holders.get(key(x), ())) < 3 or len(key(x)) < 20 or max(holders[key(x)]) == i]
        out.append((i, len(ls), len(ls) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_line_dedup(spark):
    df = frame(spark, LINES).repartition(3)
    found = line_dedup.deduplicated(df)
    assert found.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in found.collect()]
    assert sorted(got, key=repr) == plain_lines(LINES)
    assert {(r["source"], r["_lost"]) for r in found.collect()} == {("s", "x")}
    assert line_dedup.deduplicated(frame(spark, [])).count() == 0
    assert line_dedup.deduplicated(frame(spark, [(1, None)])).first()["text"] is None


def test_line_dedup_random(spark):
    rng = random.Random(5)
    pool = [f"shared line number {k} of the pool" for k in range(12)] + ["short", "", "   "]
    some = [(rng.randrange(40), "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for _ in range(120)]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in line_dedup.deduplicated(frame(spark, some)).collect()]
    assert sorted(got, key=repr) == plain_lines(some)


def plain_counts(data):
    text = data.decode()
    ws = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    return len(ws), len(set(ws)), len(re.findall("[A-Z]", text)), len(re.findall("[#$%&*|]", text)), len(text)


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_scanner(monkeypatch, block):
    monkeypatch.setattr(filter_audit, "BLOCK", block)
    rng = random.Random(block)
    texts = ["", " ", "a", "a a", "\x1c\x85  b", "漢字 漢字 É́ #|", "x" * 200, ("x" * 99 + "y ") * 3 + "x" * 99 + "z", " lead", "trail ", "", ""]
    texts += ["".join(rng.choice("ab AB\t\n#é😀") for _ in range(rng.randrange(60))) for _ in range(200)]
    rng.shuffle(texts)
    scanner = filter_audit.Scanner()
    for column in (pa.array(texts), pa.array([None, *texts, None])[1:-1], pa.array(texts, pa.large_string())[3:], pa.array([None, "ab cd", None]), pa.array([], pa.string()), pa.array([None], pa.string())):
        data, bounds = filter_audit.buffers(column)
        found = scanner(data, bounds)
        assert [tuple(r) for r in found.tolist()] == [plain_counts((t or "").encode()) for t in column.to_pylist()]


def test_scanner_of_equal_hashes(monkeypatch):
    """Words whose hashes clash are counted by their bytes."""
    monkeypatch.setattr(filter_audit.Scanner, "_hashes", lambda self, data, start, end: ((end - start) % 2).astype(np.uint64) << np.uint64(20))
    texts = ["a b c a", "aa b cc dddd b", "one two two", ""]
    found = filter_audit.Scanner()(*filter_audit.buffers(pa.array(texts)))
    assert found[:, 1].tolist() == [3, 4, 2, 0]


def plain_audit(rows, labels):
    least, good, toxic = {}, {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for part in {p or "" for *_, p in rows}:
        docs = []
        for d, t, p in rows:
            if (p or "") == part:
                n, distinct, caps, signs, points = plain_counts((t or "").encode())
                docs.append((d, {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * caps > 10 * points, "D": signs > 0, "E": d is not None and least[t or ""] < d}))
        first = Counter(next((x for x in o if f[x]), None) for o in permutations("ABCDE") for _, f in docs)
        for o in permutations("ABCDE"):
            left = docs
            for k, x in enumerate(o):
                gone = [d for d, f in left if f[x]]
                left = [(d, f) for d, f in left if not f[x]]
                failing = [f for _, f in docs if f[x]]
                only = sum(sum(f.values()) == 1 for f in failing)
                out.append((part, "".join(o), k + 1, len(left), len(gone), len(failing) - len(gone), only, sum(d in good for d in gone), sum(d in toxic for d in gone), first[x]))
    return sorted(out)


def test_filter_audit(spark):
    rng = random.Random(3)
    names = [f"word{k}" for k in range(300)]
    texts = [" ".join(rng.sample(names, 120)), " ".join(rng.sample(names, 120)) + " #", " ".join(names[:60] * 2), "X" * 30, None, "", "LOUD " * 120, " ".join(rng.sample(names, 110)).upper(), " ".join(names) * 40]
    rows = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(90)]
    labels = [(rng.choice([None, *range(30)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(30)]
    docs = spark.createDataFrame([(*r, 1, 2, "3") for r in rows], "doc_id long, text string, lang string, mask int, n int, part string").repartition(3)
    known = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, good int")
    found = filter_audit.audited(filter_audit.mask_counts(filter_audit.masks(docs), known))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect())) == plain_audit(rows, labels)
    assert filter_audit.audited(filter_audit.mask_counts(filter_audit.masks(docs.limit(0)), known.limit(0))).count() == 0
    bare = filter_audit.audited(filter_audit.mask_counts(filter_audit.masks(docs), known.limit(0)))
    assert sorted(map(tuple, bare.collect())) == plain_audit(rows, [])


def plain_spelling(rows, damage=199, least=6, often=5):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = sorted(w for w in n if len(w) >= least and n[w] >= often)

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    forms = {}
    for w in words:
        some = [v for v in words if v != w and near(w, v)]
        best = min(some, key=lambda v: (-n[v], v), default=None)
        forms[w] = (best if best and n[best] >= 5 * n[w] else None, len(some))
    out = []
    for w in words:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, forms[w][0], root, n[w], forms[w][1], n[forms[w][0]] if forms[w][0] else None))
    return out


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("damage", [None, 3])
def test_spelling(spark, monkeypatch, damage):
    rng = random.Random(9)
    base = ["letter", "letters", "lettter", "settle", "settled", "straße", "strasse", "aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaab", "ÉTÉÉTÉ", "étéété", "no", "x" * 300, "x" * 299, "x" * 298 + "y"]
    weights = [625, 125, 25, 90, 5, 40, 8, 200, 30, 6, 30, 9, 9, 50, 60, 12, 6]
    many = [w for w, k in zip(base, weights, strict=True) for _ in range(k)] + ["".join(rng.choice("ab") for _ in range(rng.randrange(6, 9))) for _ in range(4000)]
    rng.shuffle(many)
    rows = [(rng.choice([None, *range(50)]), rng.choice([" ", "-", "1", "\n"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in many[k : k + 40])) for k in range(0, len(many), 40)]
    rows += [(1, None), (2, ""), rows[0], rows[0]]
    found = spelling.grouped(frame(spark, rows).repartition(3), damage=damage)
    assert found.columns == COLUMNS
    want = plain_spelling(rows, damage)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == want and any(r[1] and r[1] != r[2] for r in want)
    monkeypatch.setattr(spelling, "LONG_TEXT", 10)
    assert spelling.counted(frame(spark, rows), damage=damage).agg({"n": "sum"}).first()[0] >= sum(r[3] for r in want)
    assert spelling.grouped(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_line_dedup"])
def test_queries_with_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries()[name](spark, SF)
    cursor = duck.execute(oracle_sql()[name])
    order = [d[0] for d in cursor.description]
    assert sorted(map(tuple, df.select(*order).collect())) == sorted(cursor.fetchall())


def test_spelling_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries()["op11_spelling"](spark, SF)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=lambda r: r[0]) == plain_spelling(rows)


def test_ids_beside_control_characters():
    """Signs that stand beside characters which only Python takes for white space get the library's ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidewatch.llm import tokens

    rng = random.Random(1)
    signs = [chr(c) for c in range(33)] + list("\x7f\x85\xa0 　.,;:!?'\"-_#é́aAbB19Σ")
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(4000)] + [f"{a}{b}{c}" for a in signs for b in signs for c in ".,a "]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        library, encoder = Tokenizer.from_file(public_tokenizers.path(name)), tokens.PieceEncoder(public_tokenizers.path(name), spaced)
        for k in range(0, len(texts), 500):
            found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.group(texts[k : k + 500])]
            assert found == [library.encode(t, add_special_tokens=False).ids for t in texts[k : k + 500]]
