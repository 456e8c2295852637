"""The near-copy stage against the true similarity of whole texts."""

import random
from collections import Counter, defaultdict

import numpy as np

from tidewatch.llm import simhash


def word(rng):
    return "".join(rng.choice("aeioubcdfgh") for _ in range(6))


def test_equal_prints_are_no_proof(spark):
    """Texts whose fingerprints agree, since one line fills half of each, stay if they share little else."""
    rng = random.Random(3)
    line = [word(rng)] * 400
    texts = [" ".join([*line, *[word(rng) for _ in range(150)]]) for _ in range(3)]
    assert len({simhash.fingerprint(t, 5) for t in texts}) == 1
    df = spark.createDataFrame([*enumerate(texts), (3, texts[1])], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.deduplicated(df).collect()) == [0, 1, 2]


def test_all_alike_pairs_are_found(spark, monkeypatch):
    """Pairs of similarity 0.8 or more whose fingerprints lie beyond ten bits are copies; a little less alike, they are not."""
    rng = random.Random(4)
    texts, far = [], 0
    while far < 12:
        base = [word(rng) for _ in range(200)]
        copy = list(base)
        for at in rng.sample(range(3, 197, 6), 4):
            copy[at] = word(rng)
        a, b = " ".join(base), " ".join(copy)
        if (simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).bit_count() > 10:
            far += 1
            texts += [a, b]
    copy = list(base)
    for at in range(3, 197, 24):
        copy[at] = word(rng)
    texts.append(" ".join(copy))
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for common, members in ((simhash.COMMON, simhash.MEMBERS), (3, 1)):
        monkeypatch.setattr(simhash, "COMMON", common)
        monkeypatch.setattr(simhash, "MEMBERS", members)
        assert sorted(r["doc_id"] for r in simhash.deduplicated(df).collect()) == [*range(0, 24, 2), 24]


def test_short_and_crowded_sets_by_keys_alone(spark):
    """Without the help of fingerprints, keys alone find all alike pairs: texts of any length, most of whose words many texts hold."""
    rng = random.Random(6)
    passages = [[word(rng) for _ in range(30)] for _ in range(4)]
    texts = []
    for n in [*range(1, 24)] * 4:
        base = [*rng.choice(passages)[: rng.randrange(30)], *[word(rng) for _ in range(n)]]
        texts += [base, [*base, word(rng)], [*base[:-1], word(rng)], base[1:], [word(rng), word(rng), *base]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    own = [{tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))} if t else set() for t in texts]
    root = list(range(len(own)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(own):
        for j in range(i):
            if a == own[j] or 5 * len(a & own[j]) >= 4 * len(a | own[j]):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in simhash.deduplicated(df, simhash.Blocks((11, 11, 11, 11, 10, 10), 3, 0)).select("doc_id").collect()}
    want = {i for i in range(len(own)) if top(i) == i}
    assert 0 < len(want) < len(own) and got == want


def test_repeated_ids_with_different_texts_stay(spark):
    """A class keeps one row; another text of the same doc_id is no copy, and goes nowhere with one."""
    rng = random.Random(5)
    a, b, c = (" ".join(word(rng) for _ in range(60)) for _ in range(3))
    df = spark.createDataFrame([(1, a), (2, b), (2, a), (2, c), (2, c), (3, b)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.deduplicated(df).collect())) == sorted([(1, a), (2, b), (2, c)])


def test_stage_against_all_pairs(spark):
    """On some thousand documents the stage keeps what a comparison of all pairs that share anything keeps."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id < 3000")
    ids, whole, holders = [], [], defaultdict(list)
    root = {}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in sorted(df.collect(), key=lambda r: r["doc_id"]):
        ws = (r["text"] or "").encode().lower().split()
        own = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else {()}
        n, shared = len(ids), Counter()
        root[n] = n
        for s in own:
            shared.update(holders[s])
            holders[s].append(n)
        for m, c in shared.items():
            if c >= 0.8 * (len(own) + len(whole[m]) - c):
                a, b = sorted((top(m), top(n)))
                root[b] = a
        ids.append(r["doc_id"])
        whole.append(own)
    want = {ids[i] for i in root if top(i) == i}
    got = {r["doc_id"] for r in simhash.deduplicated(df).select("doc_id").collect()}
    assert len(want) < len(ids) and got == want


def test_sieve_loses_no_row(spark):
    from tidewatch.llm.common import sifted

    rows = spark.range(5000).selectExpr("IF(id % 50 = 0, NULL, CAST(id % 700 AS INT)) AS doc_id", "CAST(id % 3 AS STRING) AS print", "id AS _place", "id AS word")
    few = spark.sql("SELECT * FROM VALUES (7L, '1'), (NULL, '2'), (8L, NULL), (7L, '1') AS t(doc_id, print)")
    hit, rest = sifted(rows, few, ["doc_id", "print"])
    found, left = ([tuple(r) for r in df.collect()] for df in (hit, rest))
    assert sorted(found + left, key=repr) == sorted(map(tuple, rows.collect()), key=repr) and hit.columns == rows.columns
    wanted = {(7, "1"), (None, "2")}
    assert not [r for r in left if r[:2] in wanted] and {r[:2] for r in found} >= wanted
    assert len(found) < 100  # a hash that meets one of three bits by chance is rare
    assert sifted(rows, few.limit(0), ["doc_id", "print"])[0].count() == 0


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 60, 900, 40_000):
        for shared in {0, n // 2, n}:
            both = rng.integers(0, 1 << 64, shared, dtype=np.uint64)
            x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 64, n - shared + extra, dtype=np.uint64)])) for extra in (0, n // 9))
            a, b = simhash.sketch(x), simhash.sketch(y)
            hits = lambda words: int(np.bitwise_count(words.view(np.uint64)).sum())
            bound = min(len(x) - hits(a), len(y) - hits(b)) + hits(a & b)
            assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y)) and len(a) == simhash.PLACES // 64


def test_parities_bound_what_one_set_has_alone():
    rng = np.random.default_rng(7)
    odd = lambda x: simhash.parities(x).view(np.uint64)
    told = 0
    for n in (0, 1, 3, 60, 300, 5_000):
        for shared in {0, n // 2, n}:
            both = rng.integers(0, 1 << 64, shared, dtype=np.uint64)
            x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 64, n - shared + extra, dtype=np.uint64)])) for extra in (0, n // 9))
            apart = int(np.bitwise_count(odd(x) ^ odd(y)).sum())
            assert apart <= len(np.setxor1d(x, y)) and len(odd(x)) == len(simhash.ODD)
            told += apart > len(x) + len(y) - 2 * -(-4 * (len(x) + len(y)) // 9)  # not alike, by parities alone
    assert told >= 4
