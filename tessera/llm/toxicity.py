"""Operator 9: toxicity by a classifier chain.

The chain's categories are predicted one after the other; each later model
also gets the probabilities of the earlier categories. It is trained on
out-of-fold predictions of the earlier models, so that it learns from
probabilities as good as those it meets in use. The base models are logistic
regressions over the presence of hashed words and word stems (the first
``STEM`` bytes of longer words) in whole texts; features are chosen and scaled
by their log-count ratio between the classes, within each fold.

The chain is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled texts,
taken by the hash of doc_id, up to half of them positive in the last category.
The decision threshold of a category is the one with the best F1 on the
out-of-fold probabilities. Losses, intercepts and F1 counts weigh the sampled
texts back to the shares that the last category has among all labels, so that
probabilities and thresholds mean the same however many labels there are.

Defined results: a null or empty text has no features and gets the models'
base probabilities, never a positive label; without labels all probabilities
are 0; a text labelled twice counts as positive if any of its labels is;
a null label leaves the text out of the training; repeated rows are judged
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Words, mix, table, text_slices

TRAIN_ROWS = 8000
FOLDS = 5
BITS = 20
STEM = 5
#: Least log-likelihood ratio statistic of a chosen feature and the class.
LEAST_G = 14.0
RIDGE = 1.0
#: Category, label column, label value, in the order of the chain.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))

_SHIFT = np.uint64(64 - BITS)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hashed feature, one entry per word and per stem."""
    words = Words(data, offsets)
    long = np.flatnonzero(words.end - words.start > STEM)
    # stems: the first bytes of a word, hashed like a text of their own
    start = words.start[long]
    at = (start[:, None] + np.arange(STEM)).ravel()
    stems = Words(data[at], np.arange(0, len(at) + 1, STEM)) if len(long) else None
    doc = [words.doc]
    code = [mix(words.hash) >> _SHIFT]
    if stems is not None:
        doc.append(words.doc[long])
        code.append(mix(stems.hash ^ np.uint64(0x5B)) >> _SHIFT)
    return np.concatenate(doc), np.concatenate(code).astype(np.int64)


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column(1)):
            doc, code = features(data, offsets)
            pairs = np.unique(doc << BITS | code)
            ends = np.searchsorted(pairs >> BITS, np.arange(hi - lo), "right")
            starts = np.concatenate([[0], ends[:-1]])
            raw = [(pairs[a:b] & ((1 << BITS) - 1)).astype("<i4").tobytes() for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(raw, pa.binary())], ["doc_id", "labels", "features"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _association(hit: np.ndarray, other: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Log-likelihood ratio statistic of the four counts of feature and class."""
    every = pos + neg
    part = lambda k, row, col: k * np.log(np.maximum(k, 1e-12) * every / np.maximum(row * col, 1e-12))
    with_f = hit + other
    return 2 * (part(hit, with_f, pos) + part(other, with_f, neg) + part(pos - hit, every - with_f, pos) + part(neg - other, every - with_f, neg))


class Linear:
    """Logistic regression over chosen binary features and dense extra ones."""

    def __init__(self, codes: np.ndarray, rows: np.ndarray, n: int, extra: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150):
        pos, neg = max(1, int(y.sum())), max(1, int((1 - y).sum()))
        used, place = np.unique(codes, return_inverse=True)
        hit = np.bincount(place, weights=y[rows], minlength=len(used)) if len(used) else np.zeros(0)
        other = np.bincount(place, minlength=len(used)) - hit if len(used) else np.zeros(0)
        p, q = (hit + 0.5) / (pos + 1), (other + 0.5) / (neg + 1)
        ratio = np.log(p / q)
        keep = (_association(hit, other, pos, neg) >= LEAST_G) & (hit + other >= 3)
        self.codes, scale = used[keep], ratio[keep]
        number = np.cumsum(keep) - 1
        mine = keep[place] if len(used) else np.zeros(0, bool)
        row, col = rows[mine], number[place[mine]]
        self.w, self.v, self.b = np.zeros(len(self.codes)), np.zeros(extra.shape[1]), float(np.log(max(weight @ y, 1e-9) / max(weight @ (1 - y), 1e-9))) if 0 < y.sum() < n else float(np.log(pos / neg))
        value = scale[col] if len(scale) else np.zeros(0)
        theta, speed, square = np.zeros(len(self.w) + len(self.v) + 1), 0.0, 0.0
        theta[-1] = self.b
        k = len(self.w)
        for t in range(1, steps + 1):  # Adam on the whole sample
            z = np.bincount(row, weights=theta[col] * value, minlength=n) + extra @ theta[k:-1] + theta[-1]
            d = (_sigmoid(z) - y) * weight
            grad = np.concatenate([np.bincount(col, weights=d[row] * value, minlength=k) + RIDGE * theta[:k], extra.T @ d + RIDGE * theta[k:-1], [d.sum()]]) / max(1, n)
            speed = 0.9 * speed + 0.1 * grad
            square = 0.99 * square + 0.01 * grad * grad
            theta = theta - 0.1 * (speed / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        self.w, self.v, self.b = theta[:k] * scale, theta[k:-1], float(theta[-1])

    def predict(self, codes: np.ndarray, rows: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
        """Probabilities of ``n`` texts whose distinct features are (rows, codes)."""
        z = np.full(n, self.b) + extra @ self.v
        if len(self.codes):
            at = np.searchsorted(self.codes, codes)
            known = self.codes[np.minimum(at, len(self.codes) - 1)] == codes
            z += np.bincount(rows[known], weights=self.w[at[known]], minlength=n)
        return _sigmoid(z)


class Chain:
    """Fitted models and thresholds, in the order of the categories."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS, weight: np.ndarray | None = None):
        self.models: list[Linear] = []
        self.thresholds: list[float] = []
        n = len(sets)
        if not n:
            return
        weight = np.ones(n) if weight is None else weight / weight.mean()
        rows, codes = np.repeat(np.arange(n), [len(s) for s in sets]), np.concatenate(sets).astype(np.int64)
        fold = np.arange(n) % folds
        earlier = np.zeros((n, 0))
        for k in range(labels.shape[1]):
            y = labels[:, k].astype(float)
            out = np.zeros(n)
            for f in range(folds):
                held = fold == f
                if not held.any() or held.all():
                    continue
                train, number = np.flatnonzero(~held), np.cumsum(~held) - 1
                mine = ~held[rows]
                model = Linear(codes[mine], number[rows[mine]], len(train), earlier[train], y[train], weight[train])
                own = held[rows]
                spot = np.cumsum(held) - 1
                out[held] = model.predict(codes[own], spot[rows[own]], int(held.sum()), earlier[held])
            self.models.append(Linear(codes, rows, n, earlier, y, weight))
            self.thresholds.append(_threshold(out, y, weight))
            earlier = np.column_stack([earlier, out])  # later models learn from out-of-fold predictions

    def predict(self, codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        earlier = np.zeros((n, 0))
        for model in self.models:
            earlier = np.column_stack([earlier, model.predict(codes, rows, n, earlier)])
        return earlier


def _threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The cut with the best F1; at least 0.5 where no text is positive."""
    if not y.any():
        return 0.5
    weight = np.ones(len(y)) if weight is None else weight
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum((weight * y)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + weight @ y)
    best = int(f1.argmax())
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float((p[order[best]] + below) / 2)


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, train_rows: int = TRAIN_ROWS) -> Chain:
    """Fit the chain on a bounded sample of the labelled texts."""
    marks = [F.max((F.col(column) == value).cast("int")).alias(f"__c{i}") for i, (_, column, value) in enumerate(categories)]
    whole = labels.dropna(subset=["doc_id", *{c for _, c, _ in categories}]).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(*marks)
    last = f"__c{len(categories) - 1}"
    first = F.struct(F.xxhash64("__id").alias("h"), "__id")
    positive = whole.where(F.col(last) == 1).orderBy(first).limit(train_rows // 2)
    sample = positive.unionByName(whole.where(F.col(last) == 0).orderBy(first).limit(train_rows - train_rows // 2))
    both = F.array(*[F.col(f"__c{i}") for i in range(len(categories))]).alias("labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("doc_id", "text", both)
    rows = rows.groupBy("doc_id", "labels").agg(F.max("text").alias("text")).select("doc_id", "text", "labels")  # one of repeated rows: at most train_rows
    found = rows.mapInArrow(_feature_task, "doc_id bigint, labels array<int>, features binary").collect()
    found.sort(key=lambda r: (int(mix(np.array([r["doc_id"] % (1 << 64)], np.uint64))[0]), r["features"]))
    known = np.array([r["labels"] for r in found]).reshape(len(found), len(categories))
    # How many labelled texts each sampled one stands for.
    every = {r[last]: r["count"] for r in whole.groupBy(last).count().collect()}
    most = {0: train_rows - train_rows // 2, 1: train_rows // 2}
    weight = np.array([max(1.0, every[y] / most[y]) for y in known[:, -1].tolist()])
    return Chain([np.frombuffer(r["features"], "<i4") for r in found], known, weight=weight)


def _predict_task(chain, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Chain = chain.value
        wanted = np.zeros(1 << BITS, bool)
        for model in c.models:
            wanted[model.codes] = True
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                n = hi - lo
                doc, code = features(data, offsets)
                some = np.bincount(doc, minlength=n) > 0
                used = wanted[code]
                pairs = np.unique(doc[used] << BITS | code[used])
                p = c.predict(pairs & ((1 << BITS) - 1), pairs >> BITS, n) if c.models else np.zeros((n, len(names)))
                columns = [batch.column(0).slice(lo, hi - lo)]
                for k in range(len(names)):
                    over = some & (p[:, k] >= c.thresholds[k]) if c.models else np.zeros(n, bool)
                    columns += [pa.array(p[:, k].round(6)), pa.array(over)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[x for name in names for x in (f"p_{name}", name)]])

    return run


def predict(docs: DataFrame, chain: Chain, categories=CATEGORIES) -> DataFrame:
    """doc_id and, per category, its probability and whether it is above the threshold."""
    names = [name for name, _, _ in categories]
    schema = "doc_id bigint, " + ", ".join(f"p_{n} double, {n} boolean" for n in names)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_predict_task(docs.sparkSession.sparkContext.broadcast(chain), names), schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's verdict on toxicity; the earlier category as a probability."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "toxic", "p_toxic", "p_low_quality")
