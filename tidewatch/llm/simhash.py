"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected classes.

A fingerprint has 64 bits, cut into six blocks.  Two fingerprints that differ
in at most three bits agree on at least three whole blocks, so they share one
of the twenty keys "these three blocks, these bits" (about 32 bits each).
Distinct fingerprints are joined on those keys by one shuffle; a task reads
its keys in order and compares the few fingerprints under each.  A key with
more than ``MOST`` fingerprints is not compared: its rows go round again with
one more quarter of their free bits in the key (a pair three bits apart agrees
on one quarter at least), until at most 2**14 can remain.  So no pair is lost,
no task holds more than a fixed number of rows, and copies, which share a
fingerprint, never meet as pairs at all.

``Blocks`` says how many blocks there are and how many make a key; pairs that
differ in no more bits than blocks are left over are sure to meet.

Near copies are texts whose sets of 5-word shingles have a Jaccard similarity
of 0.8 or more, and what such pairs join.  Fingerprints only propose: ``NEAR``
has 120 keys of three out of ten blocks and takes pairs up to ten bits, all of
them up to seven; each proposed link is verified on whole texts.  Pairs that
lie in different classes by then are found by an exact prefix filter over their
rarest shingles and verified likewise, so the classes are those of all pairs,
whatever the distance of their fingerprints and the size of the input.

Under a key only a star over each class is kept (members to the least), and
the stars are closed by alternating large and small stars, each round stored
in the shared folder.  Only counts and checksums reach the driver.

Defined results
  * null, empty and blank texts: fingerprint zero, linked like any other;
  * a text of one or two words: that word sequence is its only shingle;
  * repeated rows: same fingerprint, same class, one result row each;
  * null doc_id: has a fingerprint and the class of its fingerprint's least
    doc_id; a class of null doc_ids alone has a null component_id;
  * an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import met, partitions, sifted, table, unused, written
from .tokens import slices

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints under one key that a task compares; more go to finer keys.
MOST = 4096
#: Free bits at which every fingerprint under a key fits a task.
SMALL = 14
LINKS = "hot boolean, mask long, x long, y long"


@dataclass(frozen=True)
class Blocks:
    """Widths of the blocks, how many of them make a key, and the bits in which linked fingerprints may differ."""

    widths: tuple[int, ...]
    agree: int
    radius: int

    @property
    def sure(self) -> int:
        """Pairs that differ in so many bits still agree on a whole key."""
        return len(self.widths) - self.agree


EXACT = Blocks((11, 11, 11, 11, 10, 10), 3, RADIUS)
NEAR = Blocks((7, 7, 7, 7, 6, 6, 6, 6, 6, 6), 3, 10)
NEAR_SHINGLE = 5
#: Near copies: a Jaccard similarity of four fifths or more.
ALIKE = (4, 5)
#: Documents of which the common shingles are learned, and how many of these are known.
SAMPLE, COMMON = 8192, 1 << 16
#: Keys that a pair must share, where its sets have so many: a set has one more key for each beyond the first.
DEPTH = 12
#: Shared keys, counted from the rarest of all, that make a pair worth verifying.
ENOUGH = 2
#: Pairs of one set that are verified together: it is copied once for so many.
MEMBERS = 1024
#: Bits of a set's sketch.
PLACES = 4096
#: Words of 64 bits of a set's parities, which ride along with its keys.
ODD = [f"odd{k}" for k in range(16)]


def shingles(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each of the text's shingles, repeats kept; a short text is one shingle, a blank one has none."""
    import xxhash

    words = (text or "").encode().lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        return np.array([digest(join(words), seed)] if words else [], np.uint64)
    return np.fromiter((digest(join(g), seed) for g in zip(*[words[k:] for k in range(shingle)], strict=False)), np.uint64, len(words) - shingle + 1)


def voted(hashes: np.ndarray) -> int:
    """64 bits; a bit is set if it is set in over half of the hashes."""
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for start in range(0, n, 16384):
        some = hashes[start : start + 16384]
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The vote of the shingles' XXH64."""
    return voted(shingles(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                found = np.fromiter((fingerprint(t, shingle, seed) for t in rows["text"].to_pylist()), np.uint64, rows.num_rows)
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks(blocks: Blocks = EXACT) -> list[int]:
    """Bits of every choice of blocks that makes a key."""
    ends = np.cumsum(blocks.widths).tolist()
    bits = [((1 << n) - 1) << (end - n) for n, end in zip(blocks.widths, ends, strict=True)]
    return [sum(choice) for choice in combinations(bits, blocks.agree)]


def finer(mask: int, sure: int = RADIUS) -> list[int]:
    """``mask`` with each of ``sure + 1`` parts of its free bits added in turn; [] if few are free."""
    free = [b for b in range(64) if not mask >> b & 1]
    if len(free) <= SMALL:
        return []
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(free, sure + 1)]


def _classes(fp: np.ndarray, radius: int) -> np.ndarray:
    """For each of some fingerprints the first one that it reaches within ``radius`` steps."""
    n = len(fp)
    root, left = np.full(n, -1), np.arange(n)
    while len(left):
        first, front = left[0], left[:1]
        root[first], left = first, left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for start in range(0, len(front), 256):
                near |= (np.bitwise_count(fp[front[start : start + 256], None] ^ fp[None, left]) <= radius).any(0)
            front, left = left[near], left[~near]
            root[front] = first
    return root


def _compare(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    """Rows ordered by (mask, key) to star links, or back as hot rows where a key has too many."""

    def links(hot: bool, mask, x, y) -> pa.RecordBatch:
        n = len(x)
        return pa.RecordBatch.from_pydict({"hot": pa.array(np.full(n, hot)), "mask": pa.array(np.broadcast_to(mask, n).astype(np.int64)), "x": pa.array(x), "y": pa.array(y)})

    held: list[np.ndarray] = []  # rows of the key that was read last
    size, over = 0, None  # its rows held; the key if it is over MOST
    for batch in batches:
        if not batch.num_rows:
            continue
        mask, fp, node = (batch[c].to_numpy() for c in ("mask", "fp", "node"))
        rows = np.stack([mask, fp & mask, fp, node])
        if held:
            rows = np.concatenate([*held, rows], axis=1)
        cut = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
        edges = np.concatenate([[0], cut, [rows.shape[1]]])
        last = int(edges[-2])
        if over is not None and (rows[0, 0], rows[1, 0]) == over:  # more of a key that went hot before
            end = int(edges[1])
            yield links(True, rows[0, :end], rows[2, :end], rows[3, :end])
            edges = edges[1:]
            if len(edges) == 1:
                held = []
                continue
        over = None
        if len(edges) > 2:
            yield from _groups(rows, edges[:-1], blocks, links)
        tail = rows[:, last:].copy()
        mask = int(tail[0, 0]) & (1 << 64) - 1
        if tail.shape[1] > MOST and finer(mask, blocks.sure):
            yield links(True, tail[0], tail[2], tail[3])
            over, held = (tail[0, 0], tail[1, 0]), []
        else:
            held = [tail]
    if held:
        rows = held[0]
        yield from _groups(rows, np.array([0, rows.shape[1]]), blocks, links)


def _groups(rows: np.ndarray, edges: np.ndarray, blocks: Blocks, links) -> Iterator[pa.RecordBatch]:
    mask, fp, node = rows[0], rows[2].view(np.uint64), rows[3]
    sizes = np.diff(edges)
    xs, ys = [], []
    # Under a key with few fingerprints, each is compared with the one to three after it, all keys at once.
    few = np.repeat(np.where(sizes <= 4, sizes, 0), sizes)
    place = np.arange(edges[0], edges[-1]) - np.repeat(edges[:-1], sizes)
    for step in range(1, min(4, len(place))):
        at = edges[0] + np.flatnonzero(place + step < few)
        at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= blocks.radius]
        xs.append(np.maximum(node[at], node[at + step]))
        ys.append(np.minimum(node[at], node[at + step]))
    for k in np.flatnonzero(sizes > 4).tolist():
        a, b = int(edges[k]), int(edges[k + 1])
        if b - a > MOST and finer(int(mask[a]) & (1 << 64) - 1, blocks.sure):
            yield links(True, mask[a:b], rows[2, a:b], node[a:b])
            continue
        order = np.argsort(node[a:b], kind="stable")  # so that the first of a class is its least node
        own, root = node[a:b][order], _classes(fp[a:b][order], blocks.radius)
        far = root != np.arange(len(root))
        xs.append(own[far])
        ys.append(own[root[far]])
    if xs and sum(map(len, xs)):
        found = np.unique(np.stack([np.concatenate(xs), np.concatenate(ys)]), axis=1)
        yield links(False, 0, found[0], found[1])


def stars(nodes: DataFrame, blocks: Blocks = EXACT) -> DataFrame:
    """(x, y), y the lesser: links that join all pairs of ``nodes`` (fp, node) that meet and are near."""
    fp, spark = F.col("fp"), nodes.sparkSession

    def under(rows: DataFrame, choice) -> DataFrame:
        keyed = rows.select("fp", "node", F.explode(choice).alias("mask"))
        key = fp.bitwiseAND(F.col("mask"))
        ranged = keyed.select("mask", "fp", "node").repartition(partitions(spark), F.col("mask"), key).sortWithinPartitions(F.col("mask"), key)
        return written(ranged.mapInArrow(lambda batches: _compare(batches, blocks), LINKS), "simhash-links")

    level = masks(blocks)
    found = under(nodes, F.array(*[F.lit(_signed(m)) for m in level]))
    out = found.filter("not hot").select("x", "y")
    while not (hot := found.filter("hot")).isEmpty():
        # Masks of hot keys only: a list bounded by the levels' fixed choices, whatever the rows.
        level = [r["mask"] & (1 << 64) - 1 for r in hot.select("mask").distinct().collect()]
        choice = F.create_map(*[e for m in level for e in (F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in finer(m, blocks.sure)]))])
        found = under(hot.select(F.col("x").alias("fp"), F.col("y").alias("node"), choice[F.col("mask")].alias("finer")), F.col("finer"))
        out = out.union(found.filter("not hot").select("x", "y"))
    return out.distinct()


def components(links: DataFrame) -> DataFrame:
    """(x, y): each linked node but the least of its component, with that least one."""

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())

    def distinct(df: DataFrame) -> DataFrame:
        return df.filter("x != y").distinct()

    edges = written(distinct(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))), "simhash-edges")
    before, now = None, mark(edges)
    # Links are few beside the rows: their rounds are stored in as many files as they fill.
    files = min(partitions(links.sparkSession), 8 + now[0] // 250_000)
    while now != before and now[0]:
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = distinct(both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")))
        down = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(down, "x").select(F.explode(F.array(F.struct(F.col("y").alias("x"), F.col("m").alias("y")), F.struct("x", F.col("m").alias("y")))).alias("e")).select("e.*")
        edges = written(distinct(small).coalesce(files), "simhash-edges")
        before, now = now, mark(edges)
    return edges


def classes(docs: DataFrame, blocks: Blocks = EXACT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    prints = written(fingerprints(docs, shingle), "simhash-prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    known = nodes.filter("node is not null")
    least = components(stars(known, blocks))
    joined = nodes.join(least.select(F.col("x").alias("node"), F.col("y").alias("m")), "node", "left")
    named = joined.select("fp", F.coalesce("m", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def _named(whole: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingles."""
    import xxhash

    return xxhash.xxh3_64_intdigest(whole.tobytes()) - (1 << 63)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).view(np.int64) if len(values) else np.zeros(0, np.int64)))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text")).filter("doc_id is not null")


def frequent(docs: DataFrame, shingle: int = NEAR_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents of a sample hold, ascending, and in how many: at most ``COMMON``, whatever the rows.

    It only says which shingles are looked up last; the pairs that are found do not depend on it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                whole = [np.unique(shingles(t, shingle)) for t in rows["text"].to_pylist()]
                found, n = np.unique(np.concatenate(whole), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    texts = _texts(docs)
    share = max(1, texts.count() // SAMPLE)
    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    summed = some.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= 8)
    rows = sorted((r["shingle"] & (1 << 64) - 1, r["n"]) for r in summed.orderBy(F.desc("n"), "shingle").limit(COMMON).collect())
    return np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64)


def _keys(whole: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rarest first: sets that are alike share k of their first n - need + k."""
    n = len(whole)
    if not n:
        return whole
    often = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, whole), len(common) - 1)
        often = np.where(common[at] == whole, counts[at], 0)
    over, under = ALIKE
    need = -(-over * n // under)
    return whole[np.lexsort((whole, often))][: n - need + min(DEPTH, need)]


def parities(whole: np.ndarray) -> np.ndarray:
    """Whether each of equal parts of the hashes holds an odd number of a set's shingles, as signed 64-bit words.

    Two sets' parities differ in no more bits than there are shingles that one set alone has.
    """
    places = 64 * len(ODD)
    n = np.bincount((whole >> np.uint64(64 - places.bit_length() + 1)).astype(np.int64), minlength=places)
    return np.packbits((n & 1).astype(np.uint8), bitorder="little").view(np.int64)


def sets(docs: DataFrame, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """(doc_id, print, node, n, fp, parities) of every row with a doc_id: node names its set of n shingles, print its text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                hashes = [shingles(t, shingle) for t in rows["text"].to_pylist()]
                whole = [np.unique(h) for h in hashes]
                found = np.fromiter(map(voted, hashes), np.uint64, len(hashes))
                odd = np.array([parities(w) for w in whole], np.int64).reshape(len(whole), len(ODD))
                columns = [rows["doc_id"], rows["print"], pa.array([_named(w) for w in whole], pa.int64()), pa.array([len(w) for w in whole], pa.int64()), pa.array(found.view(np.int64)), *[pa.array(odd[:, k]) for k in range(len(ODD))]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "print", "node", "n", "fp", *ODD])

    return _texts(docs).mapInArrow(of, ", ".join(f"{c} long" for c in ["doc_id", "print", "node", "n", "fp", *ODD]))


def keyed(docs: DataFrame, nodes: DataFrame, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """``nodes`` (doc_id, print, ...) with the keys of their sets, taken of the whole texts anew: keys are never stored."""
    common, counts = frequent(docs, shingle)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                keys = [_keys(np.unique(shingles(t, shingle)), common, counts) for t in rows["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["print"], _lists(keys)], names=["doc_id", "print", "keys"])

    # Repeated rows have one list of keys.
    found = _texts(docs).mapInArrow(of, "doc_id long, print long, keys array<long>").groupBy("doc_id", "print").agg(F.first("keys").alias("keys"))
    return nodes.join(found, ["doc_id", "print"])


def sketch(whole: np.ndarray) -> np.ndarray:
    """``PLACES`` bits as signed 64-bit words: those that the top bits of some shingle name are set."""
    bits = np.zeros(PLACES, np.uint8)
    bits[(whole >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def beside(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the columns of ``facts`` (node, ...) for both ends, named with _x and _y.

    The pairs of a star's centre are split, and the centre's fact goes to each part.
    """
    left, right = (facts.select(F.col("node").alias(c), *[F.col(f).alias(f"{f}_{c}") for f in facts.columns if f != "node"]) for c in "xy")
    centres = written(pairs.groupBy("y").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / MEMBERS)), "simhash-centres")
    split = met(pairs, centres, ["y"], "n").withColumn("part", F.pmod(F.xxhash64("x"), "parts")).drop("parts")
    right = centres.select("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).join(right, "y")
    return split.join(left, "x").join(right, ["y", "part"]).drop("part")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """Those of ``pairs`` (x, y) whose sets of shingles, taken of the whole texts, have a Jaccard similarity of ``ALIKE`` or more.

    Sketches go first: a bit that one set alone has is a shingle that the other lacks, which bounds what both can
    share, so whole sets are moved for pairs within that bound only, and none that is alike is lost.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                whole = [np.unique(shingles(t, shingle)) for t in rows["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([_named(w) for w in whole], pa.int64()), _lists(whole), _lists([sketch(w) for w in whole])], names=["node", "whole", "bits"])

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()

    pairs = written(pairs.distinct(), "simhash-pairs")
    wanted = written(nodes.join(ends(pairs), "node", "left_semi").select("doc_id", "print"), "simhash-wanted")
    # Only texts that may be wanted are moved.
    texts = sifted(_texts(docs), wanted, ["doc_id", "print"])[0].join(wanted, ["doc_id", "print"], "left_semi").select("text")
    found = texts.mapInArrow(of, "node long, whole array<long>, bits array<long>").groupBy("node").agg(F.first("whole").alias("whole"), F.first("bits").alias("bits"))
    count = lambda words: F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))
    found = written(found.withColumn("n", F.size("whole")).withColumn("hit", count(F.col("bits"))), "simhash-whole")
    # shared / (n_x + n_y - shared) >= over / under, in whole numbers
    over, under = ALIKE
    alike = lambda shared: shared * (over + under) >= (F.col("n_x") + F.col("n_y")) * over
    both = count(F.zip_with("bits_x", "bits_y", lambda a, b: a.bitwiseAND(b)))
    most = F.least(*[F.col(f"n_{c}") - F.col(f"hit_{c}") for c in "xy"]) + both
    may = written(beside(pairs, found.select("node", "n", "hit", "bits")).filter(alike(F.least("n_x", "n_y"))).filter(alike(most)).select("x", "y"), "simhash-may")
    whole = sifted(found.select("node", "n", "whole"), written(ends(may), "simhash-ends"), ["node"])[0]
    return written(beside(may, whole).filter(alike(F.size(F.array_intersect("whole_x", "whole_y")))).select("x", "y"), "simhash-alike")


def sharing(docs: DataFrame, nodes: DataFrame, known: DataFrame, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """(x, y): every pair of ``nodes`` that may be alike, less those that ``known`` (x, y) puts in one class.

    A prefix filter in two orders.  Sets that are alike share so many keys, ``least``, that in any common order of
    the keys the first ``ENOUGH`` shared ones lie within ``size - least + ENOUGH`` places of both.  That second order is by how many
    sets hold a key, counted over all of them; keys of one class alone, which make no pair, come first and only take up places.
    So a key that many sets hold joins only sets that have few others, and of these only such as their parities
    let be alike: they bound from below how many shingles either set has alone.
    """
    classed = nodes.join(known.select(F.col("x").alias("node"), F.col("y").alias("class")), "node", "left")
    classed = classed.select("node", "n", "doc_id", "print", F.coalesce("class", "node").alias("class"))
    rows = keyed(docs, classed, shingle).select("node", "n", "class", F.size("keys").alias("size"), F.explode("keys").alias("key"))
    # Told within the one shuffle of the keys, which is the most that is ever moved.
    under, own = W.partitionBy("key"), W.partitionBy("node")
    spread = F.min("class").over(under) != F.max("class").over(under)
    rows = written(rows.withColumn("holders", F.count("*").over(under)).withColumn("spread", spread).filter("spread").drop("spread"), "simhash-keys")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("holders", "key")) - 1
    over, under_ = ALIKE
    # Whatever its partner, a set shares ``DEPTH`` keys (or all that it needs): places beyond serve nobody.
    lowest = F.least(F.lit(DEPTH), F.ceil(F.col("n") * over / under_))
    placed = rows.withColumn("at", place).filter(F.col("at") - F.col("size") < F.least(F.lit(ENOUGH), lowest) - lowest)
    placed = written(placed.drop("holders").join(nodes.select("node", *ODD), "node"), "simhash-places")
    a, b = (placed.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "class", "size", "at", *ODD)]) for s in "xy")
    shared = F.ceil((F.col("n_x") + F.col("n_y")) * over / (over + under_))
    least = F.greatest(F.lit(1), shared - F.greatest(F.col("n_x") - F.col("size_x"), F.col("n_y") - F.col("size_y")))
    within = F.greatest(F.col("at_x") - F.col("size_x"), F.col("at_y") - F.col("size_y")) < F.least(F.lit(ENOUGH), least) - least
    apart = sum(F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in ODD)
    may = (F.col("node_x") > F.col("node_y")) & (F.col("class_x") != F.col("class_y")) & (F.least("n_x", "n_y") >= shared) & within & (apart <= F.col("n_x") + F.col("n_y") - 2 * shared)
    met = a.join(b, "key").filter(may).groupBy(F.col("node_x").alias("x"), F.col("node_y").alias("y")).agg(F.count("*").alias("keys"), F.min(F.least(F.lit(ENOUGH), least)).alias("enough"))
    return met.filter("keys >= enough").select("x", "y")


def near_classes(docs: DataFrame, blocks: Blocks = NEAR, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """(doc_id, print, class) of every row with a doc_id: classes joined by all pairs of similarity ``ALIKE`` or more.

    Pairs of near fingerprints come first, since they join most copies by stars; all other pairs
    that may be alike and lie in different classes by then are found by their rarest shingles.
    """
    rows = written(sets(docs, shingle), "simhash-sets")
    nodes = written(rows.groupBy("node").agg(F.min(F.struct("doc_id", "print")).alias("s"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "fp", *ODD)]).select("node", "s.*", "copies", "n", "fp", *ODD), "simhash-nodes")
    prints = written(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("sets")), "simhash-prints")
    same = met(nodes, prints, ["fp"], "sets").filter("node != first").select(F.col("node").alias("x"), F.col("first").alias("y"))
    links = verified(docs, nodes, stars(prints.select("fp", F.col("first").alias("node")), blocks).union(same), shingle)
    links = links.union(verified(docs, nodes, sharing(docs, nodes, components(links), shingle), shingle))
    # A set that a large share of the rows hold meets its class by a broadcast.
    named = written(components(links).select(F.col("x").alias("node"), "y").join(nodes.select("node", "copies"), "node"), "simhash-named")
    return met(rows, named, ["node"], "copies").select("doc_id", "print", F.coalesce("y", "node").alias("class"))


def deduplicated(docs: DataFrame, blocks: Blocks = NEAR, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """One row of each class of near copies, that of the least doc_id, then of the least text hash; rows without a doc_id stay."""
    found = near_classes(docs, blocks, shingle)
    print_, copies, nth = unused(docs, "_print"), unused(docs, "_copies"), unused(docs, "_nth")
    # Rows that repeat a doc_id may hold different texts: a row is known by both.
    rows = written(found.groupBy("class", "doc_id", "print").agg(F.count("*").alias("copies")), "simhash-rows")
    least = rows.groupBy("class").agg(F.min(F.struct("doc_id", "print", "copies")).alias("s")).select("s.*")
    keep = written(least.select("doc_id", F.col("print").alias(print_), F.col("copies").alias(copies)), "simhash-keep")
    known = docs.filter(F.col("doc_id").isNotNull()).withColumn(print_, F.xxhash64(F.col("text").cast("string")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Rows that go, and such as are there more than once; where a row can be none of them it stays where it is.
    touched = rows.select("doc_id", F.col("print").alias(print_)).join(keep.filter(F.col(copies) == 1), ["doc_id", print_], "left_anti")
    known, stay = sifted(known, touched, ["doc_id", print_])
    alone = known.join(keep.filter(F.col(copies) == 1), ["doc_id", print_], "left_semi").select(*columns)
    # Only rows that repeat both are counted out: no other text is moved for it.
    again = known.join(keep.filter(F.col(copies) > 1), ["doc_id", print_], "left_semi")
    first = again.withColumn(nth, F.row_number().over(W.partitionBy("doc_id", print_).orderBy("text"))).filter(F.col(nth) == 1).select(*columns)
    return stay.select(*columns).union(alone).union(first).union(docs.filter(F.col("doc_id").isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
