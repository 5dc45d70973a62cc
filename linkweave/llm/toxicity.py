"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. The model of each sees the
features of the text and the probabilities that the models before it gave. In
training those are out-of-fold predictions, so a later model learns from
earlier ones as wrong as they will be on new texts. Texts with the same
features lie in the same fold, so no copy of a text predicts it.

Features are the presence of words and of their first four and five bytes.
Each model keeps those whose log-odds differ most surely from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import numbered, raw_texts, slices
from linkweave.llm.decontaminate import words_of

#: Labelled rows that a fit uses at most: those whose doc_id has the smallest hashes.
MOST_LABELLED = 6_000
MOST_FEATURES = 3_000
FOLDS = 4
CATEGORIES = ("quality", "toxic")


def _token_features(word: bytes) -> list[bytes]:
    return [word, *(b"^" + word[:k] for k in (4, 5) if len(word) > k)]


def feature_ids(raw: bytes) -> np.ndarray:
    """Distinct signed feature hashes of one UTF-8 text, sorted."""
    names = {f for w in set(words_of(raw)) for f in _token_features(w)}
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(n) for n in names), dtype=np.uint64, count=len(names)).view(np.int64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """A logistic model over chosen features and the probabilities of earlier categories."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    chained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -30.0

    def logits(self, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.bias) + (before @ self.chained if len(self.chained) else 0)
        for i, ids in enumerate(rows):
            at = np.minimum(np.searchsorted(self.ids, ids), max(len(self.ids) - 1, 0))
            if len(self.ids):
                out[i] += self.weights[at[self.ids[at] == ids]].sum()
        return out


def fit_linear(rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 150) -> Linear:
    """A fit by full-batch gradient steps; a constant where there are no rows or one class only."""
    positive = int(y.sum())
    if not len(y):
        return Linear()
    if positive in (0, len(y)):
        return Linear(bias=30.0 if positive else -30.0, chained=np.zeros(before.shape[1]))
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids, inverse = np.unique(flat, return_inverse=True)
    pos = np.bincount(inverse, weights=y[owner], minlength=len(ids))
    df = np.bincount(inverse, minlength=len(ids))
    neg = df - pos
    total_pos, total_neg = positive, len(y) - positive
    odds = np.log((pos + 0.5) / (total_pos - pos + 0.5)) - np.log((neg + 0.5) / (total_neg - neg + 0.5))
    error = np.sqrt(1 / (pos + 0.5) + 1 / (total_pos - pos + 0.5) + 1 / (neg + 0.5) + 1 / (total_neg - neg + 0.5))
    sure = np.where(df >= 4, np.abs(odds) / error, 0)
    order = np.lexsort((ids, -sure))[:MOST_FEATURES]
    chosen = np.sort(order[sure[order] > 3.0])
    column = np.full(len(ids), -1)
    column[chosen] = np.arange(len(chosen))
    cols = column[inverse]
    owner, cols = owner[cols >= 0], cols[cols >= 0]
    k, n = len(chosen), len(y)
    w, c, b = np.zeros(k), np.zeros(before.shape[1]), float(np.log(total_pos / total_neg))
    theta = np.concatenate([w, c, [b]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, c, b = theta[:k], theta[k:-1], theta[-1]
        z = np.bincount(owner, weights=w[cols], minlength=n) + before @ c + b
        gap = _sigmoid(z) - y
        grad = np.concatenate([np.bincount(cols, weights=gap[owner], minlength=k) + l2 * w, before.T @ gap + l2 * c, [gap.sum()]])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta = theta - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Linear(ids[chosen], theta[:k], theta[k:-1], float(theta[-1]))


@dataclass
class Chain:
    """Models in the order of their categories, and the threshold of the last."""

    categories: tuple[str, ...]
    models: list[Linear]
    threshold: float

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        before = np.zeros((len(rows), 0))
        for model in self.models:
            before = np.column_stack([before, _sigmoid(model.logits(rows, before))])
        return before


def folds_of(rows: list[np.ndarray], folds: int) -> np.ndarray:
    """The fold of each row, the same for rows with the same features."""
    return np.array([xxhash.xxh3_64_intdigest(ids.tobytes()) % folds for ids in rows], dtype=np.int64)


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, categories: tuple[str, ...] = CATEGORIES, folds: int = FOLDS) -> Chain:
    """``labels`` has a column for each category; a hash of its features decides the fold of a row.

    The threshold is the out-of-fold probability of the last category with the
    best F1, 0.5 at least.
    """
    n = len(rows)
    fold = folds_of(rows, folds)
    before, models = np.zeros((n, 0)), []
    for j in range(len(categories)):
        y = labels[:, j].astype(float)
        out = np.zeros(n)
        for f in range(folds):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            part = fit_linear([rows[i] for i in inside], before[inside], y[inside])
            out[outside] = part.logits([rows[i] for i in outside], before[outside])
        models.append(fit_linear(rows, before, y))
        before = np.column_stack([before, _sigmoid(out)])
    threshold = 0.5
    if n:
        p, y = before[:, -1], labels[:, -1].astype(bool)
        order = np.argsort(-p, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, n + 1) + max(y.sum(), 1))
        best = int(np.argmax(f1))
        after = p[order[best + 1]] if best + 1 < n else 0.0
        threshold = float(max(0.5, (p[order[best]] + after) / 2))
    return Chain(categories, models, threshold)


def fitted(documents: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, most: int = MOST_LABELLED) -> Chain:
    """A chain fitted on ``most`` labelled documents at most.

    Rows with a null doc_id or label are left out; without any, the chain
    rejects nothing. Labels beyond ``most`` don't matter: those with the
    smallest hashes of doc_id are taken. Of the texts only features come to the
    driver, of a bounded number of rows; each model keeps up to MOST_FEATURES
    that occur in four of them or more.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_l"), *[F.col(c).cast("int").alias(f"_y{i}") for i, c in enumerate(categories)]).dropna()
    drawn = known.orderBy(F.xxhash64("_l"), *known.columns).limit(most)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("_l"))
    rows = rows.select("doc_id", "text", *[f"_y{i}" for i in range(len(categories))])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                body, at = raw_texts(batch.column(1))
                ids = [feature_ids(body[at[i] : at[i + 1]].tobytes()) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64())), *batch.columns[2:]], names=["doc_id", "ids", *batch.schema.names[2:]])

    schema = "doc_id long, ids array<long>, " + ", ".join(f"_y{i} int" for i in range(len(categories)))
    table = rows.mapInArrow(kernel, schema).toArrow()
    ids = [np.asarray(x, dtype=np.int64) for x in table.column("ids").to_pylist()]
    y = np.column_stack([table.column(f"_y{i}").to_numpy() for i in range(len(categories))]) if len(ids) else np.zeros((0, len(categories)))
    order = sorted(range(len(ids)), key=lambda i: (xxhash.xxh3_64_intdigest(str(table.column("doc_id")[i].as_py())), tuple(y[i]), len(ids[i])))
    return fit_chain([ids[i] for i in order], (y[order] > 0).astype(int), categories)


def scored(documents: DataFrame, chain: Chain, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, p_<category> for each category, and ``rejected``: the last one at or over the threshold.

    A null or empty text has no features; repeated rows score alike; an empty
    table gives no rows.
    """
    source = documents.select(*carry, F.col("text").cast("string").alias("_text"))
    sent = documents.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]
    schema = source.drop("_text").schema
    for n in names:
        schema = schema.add(n, "double")
    schema = schema.add("rejected", "boolean")
    width = len(carry)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        wanted = np.unique(np.concatenate([m.ids for m in chain.models])) if chain.models else np.zeros(0, np.int64)
        known = set(wanted.tolist())
        seen: dict[bytes, tuple[int, ...]] = {}

        def of(word: bytes) -> tuple[int, ...]:
            found = seen.get(word)
            if found is None:
                if len(seen) > 400_000:
                    seen.clear()
                hashes = (int(np.uint64(xxhash.xxh3_64_intdigest(f)).view(np.int64)) for f in _token_features(word))
                found = seen[word] = tuple(h for h in hashes if h in known)
            return found

        for whole in batches:
            for batch in slices(whole, "_text"):
                body, at = raw_texts(batch.column(width))
                rows = []
                for i in range(batch.num_rows):
                    hits = {h for w in set(words_of(body[at[i] : at[i + 1]].tobytes())) for h in of(w)}
                    rows.append(np.array(sorted(hits), dtype=np.int64))
                p = chain.probabilities(rows)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(width)), *(pa.array(p[:, j]) for j in range(len(names))), pa.array(p[:, -1] >= chain.threshold)],
                    names=[*carry, *names, "rejected"],
                )

    return source.mapInArrow(kernel, schema)


def clean(documents: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``documents`` that the chain doesn't reject, all columns as they were, whatever their names; an empty table gives no rows."""
    whole, names, restored = numbered(documents)
    kept = scored(whole.withColumn("text", F.col(names["text"])), chain, carry=tuple(names.values())).where("NOT rejected")
    return kept.select(*restored)
