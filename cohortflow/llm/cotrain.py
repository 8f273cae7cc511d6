"""Quality classifier by co-training of two views.

The content view sees a text's hashed byte trigrams and character statistics;
the metadata view sees language, source, length and the layout of lines.  Both
start from the labelled documents.  In each round each view labels the
unlabelled documents it is sure of (calibrated probability beyond ``SURE``) and
the other isn't sure of the opposite, and the other view trains on the labels
plus these pseudo-labels.  Each view is calibrated by Platt scaling on labelled documents held out of all training; the
calibrated log-odds, less the prior counted twice, add up to the score.

The labelled documents are at most about ``MAX_LABELLED`` of those in the table
(by the hash of their id; the documented bound); a rare class keeps up to a
quarter of them, and rows weigh as their class does among all labels.  Of each
class about a third calibrates, one row at least; a class of one row does both.  The unlabelled pool is every document without a
label: each round scores all of them and trains on all that are sure.  Whole
texts are read once; their features are written as small counts.  A view starts
as a Spark ML logistic regression on the labelled documents; a round goes on
from its last weights by quasi-Newton steps on the same objective, whose loss,
gradient and (once a round) Hessian are sums that the tasks return.

Nulls: null text is empty; null metadata is a category (or zero) of its own;
null labels are left out, a null id is unlabelled and scored like any other.  A document
labelled twice is low quality if any label says so.  Repeated rows get equal
scores.  With labels of one class only, every score is that class (1.0 or 0.0);
without labels it is 0.5.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Generator, Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import class_sample, col, materialize, present_labels, small_side, text_or_empty

MAX_LABELLED = 12_000
ROUNDS = 3
SURE = 0.95
TRIGRAMS = 1024
#: Partitions of each part of the (bounded) labelled rows, and of Hessian sums.
FIT_PARTITIONS = 6
PENALTY = 0.003
#: A fit ends when a step promises less than ``TOLERANCE`` of mean log loss, or
#: after ``MAX_PASSES`` passes over the training rows.
TOLERANCE, MAX_PASSES = 1e-7, 40
SOURCES, LANGS = 64, 16


def content_counts(text: bytes) -> tuple[np.ndarray, list[float]]:
    """Counts of hashed byte trigrams; character statistics."""
    b = np.frombuffer(text, np.uint8)
    counts, n = np.zeros(TRIGRAMS, np.int64), len(b)
    if n <= 2:
        return counts, [0.0] * 7
    for s in range(0, n - 2, 1 << 20):  # bounds the memory of long texts
        x = b[s : s + (1 << 20) + 2].astype(np.uint32)
        h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
        counts += np.bincount(h >> np.uint32(22), minlength=TRIGRAMS)
    share = counts / (n - 2)
    count = np.bincount(b, minlength=256) / n
    return counts, [
        (share * share).sum() * 50, count[65:91].sum(), count[48:58].sum(), count[128:].sum(),
        count[[33, 35, 36, 37, 38, 42, 60, 62, 64, 94, 124, 126]].sum() * 5, count[[9, 10, 13, 32]].sum(), count[[44, 46]].sum() * 5,
    ]


def content_view(text: bytes) -> np.ndarray:
    """Square roots of hashed byte-trigram shares, then character statistics."""
    counts, stats = content_counts(text)
    return np.concatenate([np.sqrt(counts / max(1, len(text) - 2)), stats])


def layout(text: bytes, n_chars: int | None) -> list[float]:
    """Length and the layout of lines."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    widths = np.diff(np.concatenate([[-1], ends, [len(text)]])) - 1
    return [
        math.log1p(max(0, n_chars or 0)), n_chars is None, math.log1p(len(widths)), math.log1p(widths.mean()), math.log1p(widths.max()), (widths == 0).mean(),
    ]


def _features(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Both views of every row, small: trigram counts in the fewest bytes that
    hold them, the statistics, the buckets of language and source."""
    for b in batches:
        for s in range(0, b.num_rows, 512):
            x = b.slice(s, 512)
            counts, stats, lang, source = [], [], [], []
            for text, la, so, n in zip(*(x.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))):
                c, st = content_counts(text)
                counts.append(c.astype(np.min_scalar_type(c.max())).tobytes())
                stats.append([*map(float, st), *map(float, layout(text, n))])
                lang.append(zlib.crc32(f"lang {la}".encode()) % LANGS)
                source.append(zlib.crc32(f"source {so}".encode()) % SOURCES)
            yield pa.RecordBatch.from_arrays(
                [x.column("doc_id"), pa.array(counts, pa.binary()), pa.array(stats, pa.list_(pa.float64())), pa.array(lang, pa.int32()), pa.array(source, pa.int32())],
                names=["doc_id", "counts", "stats", "lang", "source"],
            )


def _matrices(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata features of a batch, each with a last column of 1."""
    n = b.num_rows
    content, meta = np.ones((n, TRIGRAMS + 8)), np.ones((n, LANGS + SOURCES + 7))
    for k, raw in enumerate(b.column("counts").to_pylist()):
        content[k, :TRIGRAMS] = np.frombuffer(raw, f"<u{len(raw) // TRIGRAMS}")
    grams = content[:, :TRIGRAMS]
    np.sqrt(grams / np.maximum(grams.sum(axis=1, keepdims=True), 1), out=grams)
    stats = np.array(b.column("stats").to_pylist()).reshape(n, 13)
    content[:, TRIGRAMS:-1] = stats[:, :7]
    meta[:, : LANGS + SOURCES] = 0
    meta[np.arange(n), b.column("lang").to_numpy()] = 1
    meta[np.arange(n), LANGS + b.column("source").to_numpy()] = 1
    meta[:, LANGS + SOURCES : -1] = stats[:, 7:]
    return content, meta


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, n_chars_col: str) -> DataFrame:
    return docs.select(
        col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"),
        col(lang_col).cast("string").alias("lang"), col(source_col).cast("string").alias("source"), col(n_chars_col).cast("long").alias("n_chars"),
    )


def _training_rows(rows: DataFrame, labels: DataFrame, label_id: str, quality_col: str) -> DataFrame:
    """Features of every row, written, with y and part: 0 trains, 1 calibrates,
    2 is the unlabelled pool (y null), 3 are labels beyond the bound, 4 does
    what 0 and 1 do."""
    known = labels.select(col(label_id).cast("long").alias("i"), col(quality_col).cast("int").alias("q")).where("i is not null and q in (0, 1)").groupBy("i").agg(F.min("q").cast("double").alias("y"))
    known = present_labels(rows.select(F.col("doc_id").cast("long").alias("i")), known)
    picked = class_sample(known, "y", [F.col("i")], MAX_LABELLED, "cotrain")
    # the class's first row by hash calibrates, its last trains: both have both
    h = F.xxhash64("i", F.lit("held out"))
    part = F.when(F.pmod(h, F.lit(3)) == 0, 1).otherwise(0)
    for r in picked.groupBy("y").agg(F.min(h).alias("first"), F.max(h).alias("last")).collect():
        mine = F.when(h == r["first"], 4 if r["first"] == r["last"] else 1).when(h == r["last"], 0).otherwise(part)
        part = F.when(F.col("y") == r["y"], mine).otherwise(part)
    picked = materialize(picked.select("i", part.alias("part"), "weight"))
    # about MAX_LABELLED ids at most: a proven bound for the broadcast
    known = materialize(known.join(F.broadcast(picked), "i", "left").withColumn("part", F.coalesce("part", F.lit(3))))
    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(_features, f"doc_id {kind}, counts binary, stats array<double>, lang int, source int")
    got = got.join(small_side(known, 24), F.col("doc_id").cast("long") == F.col("i"), "left")
    y = F.when(F.col("part").isin(0, 1, 4), F.col("y"))
    return materialize(got.select("doc_id", "counts", "stats", "lang", "source", y.alias("y"), F.coalesce("weight", F.lit(1.0)).alias("weight"), F.coalesce("part", F.lit(2)).alias("part")))


def _vectors(rows: DataFrame) -> DataFrame:
    """(content, meta, y, weight) of labelled rows, for Spark ML: a bounded number of
    rows in few partitions, so that an iteration is a short job."""

    def views(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                x = b.slice(s, 512)
                yield pa.RecordBatch.from_arrays([*(pa.array(list(m[:, :-1])) for m in _matrices(x)), x.column("y"), x.column("weight")], names=["content", "meta", "y", "weight"])

    got = rows.coalesce(FIT_PARTITIONS).mapInArrow(views, "content array<double>, meta array<double>, y double, weight double")
    return got.withColumns({"content": array_to_vector("content"), "meta": array_to_vector("meta")}).cache()


class View:
    """A logistic regression on one feature column, with Platt scaling."""

    def __init__(self, weights: np.ndarray, bias: float, held: DataFrame, feature: str) -> None:
        self.weights, self.bias, self.feature = weights, bias, feature
        # a 1-d fit on log-odds of rows that no training saw
        platt = LogisticRegression(featuresCol="z", labelCol="y", weightCol="weight", maxIter=30, regParam=1e-4).fit(held.select(array_to_vector(F.array(self.raw())).alias("z"), "y", "weight"))
        self.slope, self.shift = float(platt.coefficients[0]), float(platt.intercept)

    @classmethod
    def of_labels(cls, train: DataFrame, held: DataFrame, feature: str) -> View:
        model = LogisticRegression(featuresCol=feature, labelCol="y", weightCol="weight", maxIter=40, regParam=PENALTY, standardization=True).fit(train)
        return cls(model.coefficients.toArray(), float(model.intercept), held, feature)

    def raw(self) -> Column:
        w = F.array(*map(F.lit, self.weights.tolist()))
        return F.aggregate(F.zip_with(vector_to_array(self.feature), w, lambda a, b: a * b), F.lit(self.bias), lambda a, b: a + b)

    def calibrated(self) -> tuple[np.ndarray, float]:
        """Weights and bias whose sum is the calibrated log-odds."""
        return self.weights * self.slope, self.bias * self.slope + self.shift


def _sums(rows: DataFrame, teachers: list[np.ndarray], edge: float, at: dict[int, np.ndarray], hessian: bool) -> dict[int, tuple[np.ndarray, np.ndarray | None]]:
    """Per view of ``at`` (0 content, 1 metadata): sums over its training rows,
    which are the labelled ones and those the other view's teacher is sure of,
    but for those its own teacher is sure are wrong.  The sums are loss, count,
    gradient, features, squared features; and, if asked for, the Hessian."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = {k: np.zeros(2 + 3 * len(w)) for k, w in at.items()}
        square = {k: np.zeros((len(w), len(w))) for k, w in at.items()} if hessian else {}
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                both = _matrices(part)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(float)  # null: nan
                weight = part.column("weight").to_numpy()
                logit = [x @ t for x, t in zip(both, teachers)]
                for k, w in at.items():
                    own, other = logit[k], logit[1 - k]
                    sure = (np.abs(other) >= edge) & np.where(other > 0, own > -edge, own < edge)
                    use = sure | ~np.isnan(y)
                    x, t, m = both[k][use], np.where(np.isnan(y), other > 0, y)[use], weight[use]
                    z = x @ w
                    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    total[k] += np.concatenate([[m @ (np.logaddexp(0, z) - t * z), m.sum()], (m * (p - t)) @ x, m @ x, np.einsum("i,ij,ij->j", m, x, x)])
                    if hessian:
                        half = (x * np.sqrt(m * p * (1 - p))[:, None]).astype(np.float32)
                        square[k] += half.T @ half
        for k in at:
            out = [(-1, total[k]), *((r, square[k][r, r:]) for r in range(len(at[k])) if hessian)]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(out), pa.int32()), pa.array([r for r, _ in out], pa.int32()), pa.array([v.tobytes() for _, v in out], pa.binary())], names=["view", "row", "v"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        got: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for *key, v in zip(*(b.column(c).to_pylist() for c in ("view", "row", "v"))):
                got[tuple(key)] = got.get(tuple(key), 0) + np.frombuffer(v)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int32()), pa.array([r for _, r in got], pa.int32()), pa.array([v.tobytes() for v in got.values()], pa.binary())], names=["view", "row", "v"])

    schema = "view int, row int, v binary"
    parts = rows.mapInArrow(task, schema)
    if hessian:  # rows of the task's Hessians are added up before the driver sees them
        parts = parts.repartition(FIT_PARTITIONS, "view", "row").mapInArrow(add, schema)
    total, square = {k: np.zeros(2 + 3 * len(w)) for k, w in at.items()}, {k: np.zeros((len(w), len(w))) for k, w in at.items()}
    for k, r, v in parts.collect():
        if r < 0:
            total[k] += np.frombuffer(v)
        else:
            square[k][r, r:] += np.frombuffer(v)
    return {k: (total[k], square[k] + np.triu(square[k], 1).T if hessian else None) for k in at}


def _inverse(a: np.ndarray) -> np.ndarray:
    """Inverse of a positive definite matrix, by Gauss-Jordan steps on whole
    rows: the driver starts no BLAS threads."""
    a = a.copy()
    for k in range(len(a)):
        pivot, column = a[k, k], a[:, k].copy()
        row = a[k] / pivot
        a -= column[:, None] * row
        a[k], a[:, k] = row, -column / pivot
        a[k, k] = 1 / pivot
    return a


def _descend(w: np.ndarray) -> Generator[np.ndarray, tuple[np.ndarray, np.ndarray | None], np.ndarray]:
    """Minimise mean log loss plus the penalty on standardised weights, from
    ``w``: yields a point, is sent its sums (the first with the Hessian)."""
    d = len(w)
    total, square = yield w
    n = total[1]
    mean = total[2 + d : 2 + 2 * d] / n
    spread = np.maximum(total[2 + 2 * d :] / n - mean * mean, 0)
    # a constant feature is left to the intercept, which has no penalty
    ridge = np.where(spread > 1e-12, PENALTY * spread, 1.0)
    ridge[-1] = 0

    def value(w: np.ndarray, total: np.ndarray) -> tuple[float, np.ndarray]:
        return total[0] / n + 0.5 * (ridge * w * w).sum(), total[2 : 2 + d] / n + ridge * w

    inverse = _inverse(square / n + np.diag(ridge + 1e-10))
    f, g = value(w, total)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    step = None
    for _ in range(MAX_PASSES):
        if step is None:
            q, back = g.copy(), []
            for s, y in reversed(pairs):
                back.append(a := (s @ q) / (s @ y))
                q -= a * y
            q = np.einsum("ij,j->i", inverse, q)
            for (s, y), a in zip(pairs, reversed(back)):
                q += (a - (y @ q) / (s @ y)) * s
            step = -q
        if -(g @ step) / 2 < TOLERANCE:
            break
        total, _ = yield w + step
        f2, g2 = value(w + step, total)
        if f2 > f:
            step = step / 2
            continue
        if step @ (g2 - g) > 0:
            pairs.append((step, g2 - g))
        w, f, g, step = w + step, f2, g2, None
    return w


def cotrain(rows: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> tuple[View, View, float]:
    """Content view, metadata view, prior log-odds from ``_training_rows``."""
    train, held = (_vectors(rows.where(f"part in ({k}, 4)")) for k in range(2))
    share = held.agg(F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).first()[0]
    prior = math.log(share / (1 - share))
    edge = math.log(sure / (1 - sure))
    # a task a core: each returns one set of sums, however large the pool
    all_rows = rows.where("part in (0, 2, 4)").select("counts", "stats", "lang", "source", "y", "weight").coalesce(max(FIT_PARTITIONS, rows.sparkSession.sparkContext.defaultParallelism))
    views = [View.of_labels(train, held, "content"), View.of_labels(train, held, "meta")]
    for _ in range(rounds):
        teachers = [np.append(*v.calibrated()) for v in views]
        fits = {k: _descend(np.append(v.weights, v.bias)) for k, v in enumerate(views)}
        at, done, first = {k: next(fit) for k, fit in fits.items()}, {}, True
        while at:
            got, at = _sums(all_rows, teachers, edge, at, first), {}
            for k, sums in got.items():
                try:
                    at[k] = fits[k].send(sums)
                except StopIteration as end:
                    done[k] = end.value
            first = False
        views = [View(done[k][:-1], float(done[k][-1]), held, name) for k, name in enumerate(("content", "meta"))]
    for x in (train, held):
        x.unpersist()
    return *views, prior


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", n_chars_col: str = "n_chars", label_id: str = "doc_id", quality_col: str = "quality", rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, p_content, p_metadata, score, kept (score >= 0.5)."""
    rows = _rows(docs, id_col, text_col, lang_col, source_col, n_chars_col)
    training = _training_rows(rows, labels, label_id, quality_col)
    seen = {r["y"] for r in training.where("y is not null").select("y").distinct().collect()}
    if len(seen) < 2:
        only = F.lit(0.5 if len(seen) != 1 else seen.pop())
        return rows.select("doc_id", only.alias("p_content"), only.alias("p_metadata"), only.alias("score"), (only >= 0.5).alias("kept"))
    content, meta, prior = cotrain(training, rounds)
    views = [np.append(*v.calibrated()) for v in (content, meta)]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                logits = np.array([[float(x @ w) for x, w in zip(pair, views)] for pair in zip(*_matrices(part))]).reshape(-1, 2)
                both = logits.sum(axis=1) - prior
                p = 1 / (1 + np.exp(-np.clip(np.column_stack([logits, both]), -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(p[:, k]) for k in range(3)), pa.array(p[:, 2] >= 0.5)], names=["doc_id", "p_content", "p_metadata", "score", "kept"])

    kind = rows.schema[0].dataType.simpleString()
    return training.select("doc_id", "counts", "stats", "lang", "source").mapInArrow(score, f"doc_id {kind}, p_content double, p_metadata double, score double, kept boolean")
