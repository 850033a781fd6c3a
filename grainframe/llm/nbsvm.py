"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by naive Bayes.

1. Labelled training texts say which n-grams they hold.  N-grams are of tokens
   (runs of letters and runs of punctuation, case kept; one and two of them) and of
   token shapes (case, digits, punctuation, same as the token before; one to three).
   Class counts are over at most ``COUNTED`` training rows a class (``labelled.py``);
   their log ratio scales the indicators.
2. On a bounded sample of at most ``SAMPLE`` rows a class, a linear model is fitted to the
   scaled and normalised indicators by dual coordinate descent on the hinge loss, and
   blended with the mean of its weights.
3. Scores are the logistic of the margin, for every whole text.

Defined results: null and empty texts hold no n-gram and score as the bias alone says;
repeated rows score alike; without training rows of both classes every score is 0.5; a
null id is never held out; extra columns pass through, ``held_out``, ``score`` and
``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from grainframe.llm.labelled import bounded_sample, fold_of, labelled
from grainframe.llm.words import SPLIT, Words, mix, slices, words_of

FEATURES = 1 << 18
SAMPLE = 2000
SMOOTHING = 1.0
BLEND = 0.75
COST = 4.0
EPOCHS = 20


def _shapes(words: Words) -> np.ndarray:
    """A small number per token: its kind of characters and whether it repeats the last one."""
    first, last = words.data[words.starts], words.data[words.ends - 1]
    upper = lambda b: (b >= 65) & (b <= 90)
    lower = lambda b: ((b >= 97) & (b <= 122)) | (b >= 128)
    digit = (first >= 48) & (first <= 57)
    shape = np.select(
        [SPLIT[first] == 2, digit, upper(first) & upper(last), upper(first), lower(first)],
        [8 + first.astype(np.int64), 1, 2, 3, 4], 5,
    )
    size = np.minimum(words.ends - words.starts, 3)
    same = np.zeros(len(shape), dtype=np.int64)
    same[1:] = words.codes[1:] == words.codes[:-1]
    return ((shape * 4 + np.where(SPLIT[first] == 2, size, 0)) * 2 + same).astype(np.uint64)


def indicators(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature numbers of each text, and where each text's begin."""
    words = words_of(column, fold=False, kinds=SPLIT)
    owner, found = words.owner(), []
    for kind, unit in ((1, words.codes), (2, mix(_shapes(words) + np.uint64(1)))):
        code = unit
        for size in range(1, kind + 2):
            if size > 1:
                code = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + unit[size - 1 :]
            n = len(code)
            inside = owner[:n] == owner[size - 1 :] if n else np.zeros(0, dtype=bool)
            feature = mix(code + np.uint64(8 * kind + size)) % np.uint64(FEATURES)
            found.append(owner[:n][inside] * FEATURES + feature[inside].astype(np.int64))
    pairs = np.unique(np.concatenate(found))
    return pairs % FEATURES, np.searchsorted(pairs, np.arange(len(words) + 1) * FEATURES)


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each feature, by label, and texts of each label."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros((2, FEATURES), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                label = batch.column("label").to_numpy()
                features, first = indicators(batch.column("text"))
                of = np.repeat(label, np.diff(first))
                for value in (0, 1):
                    counts[value] += np.bincount(features[of == value], minlength=FEATURES)
                    texts[value] += int((label == value).sum())
        some = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1))]
            + [pa.array(np.append(counts[v][some], texts[v])) for v in (0, 1)],
            ["feature", "n0", "n1"],
        )

    sums = rows.select("text", "label").mapInArrow(scan, "feature long, n0 long, n1 long").groupBy(
        "feature"
    ).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts, texts = np.zeros((2, FEATURES)), np.zeros(2)
    real = sums[sums["feature"] >= 0]
    for value in (0, 1):
        counts[value][real["feature"]] = real[f"n{value}"]
        texts[value] = sums.loc[sums["feature"] < 0, f"n{value}"].sum()
    return counts, texts


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of label 1 against label 0."""
    share = counts + SMOOTHING * (counts.sum(0) > 0)
    share = share / np.maximum(share.sum(1, keepdims=True), 1)
    return np.where(counts.sum(0) > 0, np.log(np.maximum(share[1], 1e-12) / np.maximum(share[0], 1e-12)), 0.0)


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, seed: int = 5
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model; classes cost alike whatever their sizes."""
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max(1, (labels == v).sum()) for v in (0, 1)]) / max(1, len(labels))
    limit = COST / (2 * share[labels])
    weights, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            gradient = sign[i] * (weights[at] @ value + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), limit[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[at] += step * value
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def _scaled(features: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    value = ratio[features]
    return value / max(float(np.linalg.norm(value)), 1e-9)


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Log ratios, blended weights and bias from ``text, label`` rows."""
    counts, texts = class_counts(rows)
    ratio = log_ratio(counts)
    if not texts.all():
        return ratio, np.zeros(FEATURES), 0.0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                features, first = indicators(batch.column("text"))
                lists = pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(features.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([batch.column("label"), lists], ["label", "features"])

    chosen = bounded_sample(rows, sample).select("label", "text")
    local = chosen.mapInArrow(scan, "label int, features array<int>").toArrow()
    labels = local.column("label").to_numpy()
    lists = [x.values.to_numpy() for x in local.column("features")]
    data = [(f, _scaled(f, ratio)) for f in lists]
    weights, bias = dual_coordinate_descent(data, labels, FEATURES)
    used = weights != 0
    mean = np.abs(weights[used]).mean() if used.any() else 0.0
    weights = np.where(ratio != 0, BLEND * weights + (1 - BLEND) * mean, 0.0)
    margins = np.array([weights[f] @ v for f, v in data])
    low, high = np.quantile(margins[labels == 0], 0.9), np.quantile(margins[labels == 1], 0.1)
    return ratio, weights, -float((low + high) / 2)


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; learns from the other folds."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("held_out", "score", "predicted")
    known = labelled(docs, labels.where(fold_of(folds) != held_out), label, sample)
    ratio, weights, bias = fit(known, sample)
    strength = (ratio * weights).astype(np.float32)
    squares = (ratio * ratio).astype(np.float32)
    schema = StructType([*docs.schema, StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                features, first = indicators(batch.column("text"))
                sums = np.concatenate([[0.0], np.cumsum(strength[features], dtype=np.float64)])
                norms = np.concatenate([[0.0], np.cumsum(squares[features], dtype=np.float64)])
                dot, norm = (x[first[1:]] - x[first[:-1]] for x in (sums, norms))
                margin = dot / np.sqrt(np.maximum(norm, 1e-12)) * (norm > 1e-9) + bias
                score = 1 / (1 + np.exp(-np.clip(4 * margin, -30, 30)))
                columns = [batch.column(f.name).cast(f.type) for f in arrow if f.name != "score"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], schema=arrow)

    scored = docs.mapInArrow(scan, schema)
    return scored.select(
        *docs.columns,
        F.coalesce(fold_of(folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
