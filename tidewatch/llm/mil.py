"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes; only the document has a
label.  Every passage is described by what its bytes are (letters, capitals,
blanks, signs, how many of its four-byte runs are new) and encoded by a learned
layer.  Gated attention, tanh(V h) * sigmoid(U h), gives each passage a weight
among those of its document, and the weighted mean of encodings is scored.  So
one spoilt paragraph in a long text can decide, and its weight shows which.

The model is small, is fitted by the driver with Adam on a bounded sample of
labelled documents and travels with the tasks.  The sample takes documents of
each class by a hash of doc_id, whole ones with all their passages, until it has
``SAMPLE`` of them or ``TRAIN_PASSAGES`` passages.  A round of learning goes over
``BAGS`` documents at once, so long texts need no more memory than their own.
Scoring reads whole texts, any number of passages, without a shuffle.

Defined results
  * null and empty texts: one empty passage, hence a score as any other;
  * a null doc_id is not held out;
  * labels that are null or disagree for one doc_id are not learned from; if
    one class has no label, the score is the share of the other everywhere,
    and 0.5 without any label;
  * a doc_id with several texts: the one with the least hash is learned from;
  * repeated rows: equal scores; an empty table gives no rows; columns other
    than doc_id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .tokens import slices

PASSAGE = 512
SAMPLE = 3000
#: Passages of a class beyond which no further document is taken.
TRAIN_PASSAGES = 20_000
ENCODED, ATTENTION = 24, 12
BAGS = 1024
STEPS, RATE, DECAY = 600, 0.015, 1e-4
SEED = 7
FOLDS = 5
KEEP = 0.3

_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " ", "\n", "0123456789", ".", ",", "!", "|", "#*$%&<>@^~=+_/\\`{}[]", "'\"():;?-")
_CLASS = np.full(256, len(_KINDS), np.uint8)  # the rest: bytes beyond ASCII and controls
for _n, _kind in enumerate(_KINDS):
    _CLASS[np.frombuffer(_kind.encode(), np.uint8)] = _n
_PAD = len(_KINDS) + 1
WIDTH = _PAD + 4


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions of all passages, and how many each text has."""
    raw = [(t or "").encode() for t in texts]
    counts = np.array([max(1, -(-len(r) // PASSAGE)) for r in raw], np.int64)
    data = b"".join(r.ljust(c * PASSAGE, b"\0") for r, c in zip(raw, counts.tolist(), strict=True))
    out = np.empty((int(counts.sum()), WIDTH), np.float32)
    grid = np.frombuffer(data, np.uint8).reshape(-1, PASSAGE)
    left = np.full(len(grid), PASSAGE, np.int64)
    left[np.cumsum(counts) - 1] = np.array([len(r) for r in raw]) - (counts - 1) * PASSAGE
    for start in range(0, len(grid), 2048):
        out[start : start + 2048] = _described(grid[start : start + 2048], left[start : start + 2048])
    return out, counts


def _described(grid: np.ndarray, length: np.ndarray) -> np.ndarray:
    n = len(grid)
    kind = _CLASS[grid]
    kind[np.arange(PASSAGE) >= length[:, None]] = _PAD
    seen = np.bincount((np.arange(n)[:, None] * (_PAD + 1) + kind).ravel(), minlength=n * (_PAD + 1)).reshape(n, _PAD + 1)[:, :_PAD]
    whole = np.maximum(length, 1)
    blank = (kind == 2) | (kind == 3)
    capital = ((kind[:, 1:] == 1) & blank[:, :-1]).sum(1)
    runs = grid[:, :-3].astype(np.uint32) | grid[:, 1:-2].astype(np.uint32) << 8 | grid[:, 2:-1].astype(np.uint32) << 16 | grid[:, 3:].astype(np.uint32) << 24
    runs.sort(axis=1)
    new = (runs[:, 1:] != runs[:, :-1]).sum(1) + 1
    words = blank.sum(1) + 1
    extra = np.stack([new / whole, (whole - words) / words / 10.0, capital / words, np.log1p(length) / 6.0], axis=1)
    return np.concatenate([seen / whole[:, None], extra], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Model:
    """Parameters of the encoder, the gated attention and the score."""

    def __init__(self, width: int = WIDTH):
        rng = np.random.default_rng(SEED)
        make = lambda a, b: rng.standard_normal((a, b)) / np.sqrt(a)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.prior: float | None = None
        self.p = {
            "W": make(width, ENCODED), "b": np.zeros(ENCODED), "V": make(ENCODED, ATTENTION), "U": make(ENCODED, ATTENTION),
            "w": make(ATTENTION, 1)[:, 0], "c": make(ENCODED, 1)[:, 0], "d": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        p, starts = self.p, np.cumsum(counts) - counts
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"][0])}

    def scores(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each bag."""
        if self.prior is not None:
            return np.full(len(counts), self.prior)
        return self._forward((x - self.mean) / self.scale, counts)["y"]

    def attention(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weight of each passage within its bag."""
        return self._forward((x - self.mean) / self.scale, counts)["a"]

    def fit(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray) -> Model:
        if not len(label) or label.min() == label.max():
            self.prior = float(label.mean()) if len(label) else 0.5
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1.0 - label.mean()))
        starts, rng, order = np.cumsum(counts) - counts, np.random.default_rng(SEED), np.empty(0, np.int64)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            if not len(order):
                order = rng.permutation(len(label))
            bags, order = order[:BAGS], order[BAGS:]
            own = counts[bags]
            rows = np.repeat(starts[bags] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            rate = RATE * min(1.0, 2.0 * (1.0 - (step - 1) / STEPS))
            for k, grad in self._gradient(x[rows], own, label[bags], weight[bags] / len(bags)).items():
                grad = grad + DECAY * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, counts)
        h, t, g, a, z = (f[k] for k in "htgaz")
        starts = np.cumsum(counts) - counts
        dy = (f["y"] - label) * share
        dz = np.repeat(dy[:, None] * p["c"], counts, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ dy, "d": np.array([dy.sum()])}


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", n: int = SAMPLE, limit: int = TRAIN_PASSAGES) -> list[tuple[int, int, bytes]]:
    """(label, passages, descriptions) of learned documents: of each class at most ``n``, and none once ``limit`` passages are taken."""
    agreed = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    agreed = agreed.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").select("doc_id", "y")
    chosen = [agreed.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c in (0, 1)]
    # At most 2n rows of two numbers: a size fixed by the parameter, whatever the corpus.
    wanted = F.broadcast(written(chosen[0].union(chosen[1]), "mil-labels"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    print_, size = F.coalesce(F.xxhash64("text"), F.lit(0)), F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / PASSAGE)).cast("long")
    found = rows.join(wanted, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(print_.alias("print"), size.alias("n"))).alias("s"))
    taken, left = [], [limit, limit]
    mixed = F.xxhash64("doc_id")
    for r in found.select("doc_id", "y", "s.*", mixed.alias("nth")).orderBy("nth", "doc_id").collect():  # 2n at most
        if left[r["y"]] > 0:
            left[r["y"]] -= r["n"]
            taken.append((r["doc_id"], r["y"], r["print"], r["n"]))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, counts = passages(part["text"].to_pylist())
                ends = (np.cumsum(counts) * WIDTH * 4).tolist()
                raw = x.tobytes()
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary())], names=["doc_id", "x"])

    if not taken:
        return []
    names = docs.sparkSession.createDataFrame([(i, p) for i, _, p, _ in taken], "doc_id long, print long")
    texts = rows.join(F.broadcast(names), "doc_id").filter(print_ == F.col("print")).select("doc_id", "text")
    described = texts.mapInArrow(describe, "doc_id long, x binary").groupBy("doc_id").agg(F.first("x").alias("x"))
    by = {r["doc_id"]: bytes(r["x"]) for r in described.collect()}
    return [(y, n, by[i]) for i, y, _, n in sorted(taken)]


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", n: int = SAMPLE) -> Model:
    rows = sample(docs, labels, label, n)
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(-1, WIDTH).astype(np.float64)
    return Model().fit(x, np.array([r[1] for r in rows], np.int64), np.array([r[0] for r in rows], np.float64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(model.scores(*passages(rows["text"].to_pylist())), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double")


def filtered(docs: DataFrame, model: Model, least: float = KEEP) -> DataFrame:
    """The rows whose score is at least ``least``, with their own columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                kept = model.scores(*passages(rows["text"].to_pylist())) >= least
                if kept.any():
                    yield rows.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"))
