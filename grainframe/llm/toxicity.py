"""Toxicity: a convolutional text classifier trained in numpy.

Tokens (runs of letters, A-Z lower-cased, and runs of punctuation) have hashed
embeddings, the sum of one for the token and one for its first bytes, so that unseen
forms of a known stem are not blank.  Filters of several widths are max-pooled over the
whole text and feed a logistic unit.  The first embedding dimension starts at the log
ratio of classes counted over at most ``COUNTED`` labelled training rows a class
(``labelled.py``); the rest starts at random, and
everything is trained by adaptive gradient steps on a bounded sample of at most
``SAMPLE`` rows a class.  Every labelled training row that the network was not trained on,
a quarter of the sample among them, then sets one threshold per language: their logits are
counted in bins by language and label, and the cut with the fewest mistakes is taken.
Languages are told from function words of the text itself; one with fewer than ``FEW``
such rows of a class takes the cut of all rows.  Scores are shifted so that 0.5 is the cut.

For scoring, embeddings are multiplied by the filters once, so a text costs table
look-ups, sums and a maximum.

Defined results: null and empty texts pool nothing and score as the bias says; repeated
rows score alike; without training rows of both classes every score is 0.5 less a grain,
so nothing is called toxic; a null id is never held out; extra columns pass through,
``held_out``, ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from grainframe.llm.labelled import bounded_sample, fold_of, labelled
from grainframe.llm.words import SPLIT, Words, code_of, mix, prefix_codes, slices, words_of

BUCKETS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX_BYTES = 4
SAMPLE = 1500
EPOCHS = 6
RATE = 0.05
SCORE_BYTES = 500_000
#: Rows of either class that a threshold of a language needs, and bins a unit of the logit has.
FEW, BINS = 10, 100

#: Function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with as on by",
    "de": "der die und das nicht ist von mit den dem ein sich auf im",
    "fr": "le la les des et est une du dans pour que qui pas sur",
    "es": "el los las del que y una por con para se es un al",
}
_LANGUAGES = [np.sort(np.array([code_of(w) for w in x.split()], dtype=np.uint64)) for x in FUNCTION_WORDS.values()]


def _tokens(column: pa.Array) -> Words:
    return words_of(column, kinds=SPLIT)


def _ids(words: Words) -> np.ndarray:
    """Two table rows per token: its own, and its stem's in the second half."""
    own = words.codes % np.uint64(BUCKETS)
    stem = mix(prefix_codes(words, PREFIX_BYTES)) % np.uint64(BUCKETS)
    return np.stack([own.astype(np.int32), stem.astype(np.int32) + BUCKETS], axis=1)


def _language(words: Words) -> np.ndarray:
    """Number of the likeliest language of each text; the last number is none."""
    sums = []
    for known in _LANGUAGES:
        at = np.minimum(np.searchsorted(known, words.codes), len(known) - 1)
        hits = np.concatenate([[0], np.cumsum(known[at] == words.codes)])
        sums.append(hits[words.first[1:]] - hits[words.first[:-1]])
    votes = np.stack(sums)
    return np.where(votes.max(0) > 0, votes.argmax(0), len(_LANGUAGES))


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each table row, by label, and texts by label, over all of ``rows``."""
    size = 2 * BUCKETS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros((2, size), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                label, words = batch.column("label").to_numpy(), _tokens(batch.column("text"))
                pairs = np.unique(np.repeat(words.owner(), 2) * size + _ids(words).ravel())
                of, row = label[pairs // size], pairs % size
                for value in (0, 1):
                    counts[value] += np.bincount(row[of == value], minlength=size)
                    texts[value] += int((label == value).sum())
        some = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1))]
            + [pa.array(np.append(counts[v][some], texts[v])) for v in (0, 1)],
            ["row", "n0", "n1"],
        )

    sums = rows.select("text", "label").mapInArrow(scan, "row long, n0 long, n1 long").groupBy(
        "row"
    ).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts, texts = np.zeros((2, size)), np.zeros(2)
    real = sums[sums["row"] >= 0]
    for value in (0, 1):
        counts[value][real["row"]] = real[f"n{value}"]
        texts[value] = sums.loc[sums["row"] < 0, f"n{value}"].sum()
    return counts, texts


class Network:
    """Embeddings, filters and the output unit, with their accumulated squared gradients."""

    def __init__(self, counts: np.ndarray, texts: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.05, (2 * BUCKETS, DIM))
        held = counts.sum(0)
        ratio = np.log((counts[1] + 0.5) / (texts[1] + 1)) - np.log((counts[0] + 0.5) / (texts[0] + 1))
        # half from the token, half from its stem, drawn to none where little was seen
        self.table[:, 0] = 0.5 * np.clip(ratio, -2, 4) * held / (held + 4)
        self.filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)) for w in WIDTHS]
        for f in self.filters:
            f[0, 0, : FILTERS // 2] += 1.0
        self.offsets = [np.full(FILTERS, -0.5) for _ in WIDTHS]
        self.out = np.full(FILTERS * len(WIDTHS), 0.2)
        self.bias = -2.0
        self.seen = {
            "table": np.full(self.table.shape, 1e-3), "out": np.full(self.out.shape, 1e-3), "bias": 1e-3,
            "filters": [np.full(f.shape, 1e-3) for f in self.filters],
            "offsets": [np.full(o.shape, 1e-3) for o in self.offsets],
        }

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Embeddings, pooled activations and where each filter was highest."""
        x = self.table[ids[:, 0]] + self.table[ids[:, 1]]
        features, peaks = [], []
        for f, offset in zip(self.filters, self.offsets):
            n = len(x) - len(f) + 1
            if n <= 0:
                features.append(np.zeros(FILTERS))
                peaks.append(np.full(FILTERS, -1))
                continue
            y = x[:n] @ f[0]
            for j in range(1, len(f)):
                y += x[j : j + n] @ f[j]
            top = y.argmax(0)
            features.append(np.maximum(y[top, np.arange(FILTERS)] + offset, 0))
            peaks.append(np.where(features[-1] > 0, top, -1))
        return x, np.concatenate(features), peaks

    def logit(self, ids: np.ndarray) -> float:
        return float(self.pooled(ids)[1] @ self.out + self.bias)

    def _move(self, value, seen, gradient, at=...):
        seen[at] += gradient * gradient
        value[at] -= RATE * gradient / np.sqrt(seen[at])

    def learn(self, ids: np.ndarray, label: int) -> None:
        x, feature, peaks = self.pooled(ids)
        slope = 1 / (1 + np.exp(-(feature @ self.out + self.bias))) - label
        if abs(slope) < 0.02:
            return
        back = slope * self.out
        self._move(self.out, self.seen["out"], slope * feature)
        self.seen["bias"] += slope * slope
        self.bias -= RATE * slope / np.sqrt(self.seen["bias"])
        rows: dict[int, np.ndarray] = {}
        for k, (f, top) in enumerate(zip(self.filters, peaks)):
            change, shift = np.zeros(f.shape), np.zeros(FILTERS)
            for c in np.flatnonzero(top >= 0):
                g = back[k * FILTERS + c]
                shift[c] = g
                for j in range(len(f)):
                    change[j, :, c] = g * x[top[c] + j]
                    for row in ids[top[c] + j]:
                        rows[row] = rows.get(row, 0) + g * f[j, :, c]
            self._move(f, self.seen["filters"][k], change)
            self._move(self.offsets[k], self.seen["offsets"][k], shift)
        for row, g in rows.items():
            self._move(self.table, self.seen["table"], g, row)

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per width, table rows times each filter position, and the offsets."""
        return [
            (np.stack([self.table @ f[j] for j in range(len(f))]).astype(np.float32), o.astype(np.float32))
            for f, o in zip(self.filters, self.offsets)
        ]


def _pool_all(ids: np.ndarray, first: np.ndarray, tables: list) -> np.ndarray:
    """Pooled features of every text of a slice."""
    count = np.diff(first)
    features = np.zeros((len(count), FILTERS * len(tables)), dtype=np.float32)
    for k, (table, offset) in enumerate(tables):
        width = len(table)
        n = len(ids) - width + 1
        some = np.flatnonzero(count >= width)
        if n <= 0 or not len(some):
            continue
        y = table[0][ids[:n, 0]] + table[0][ids[:n, 1]]
        for j in range(1, width):
            y += table[j][ids[j : j + n, 0]]
            y += table[j][ids[j : j + n, 1]]
        bounds = np.stack([first[some], first[some + 1] - width + 1], axis=1).ravel()
        cut = bounds[:-1] if bounds[-1] >= n else bounds
        top = np.maximum.reduceat(y, cut, axis=0)[::2]
        features[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top + offset, 0)
    return features


def _threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the fewest mistakes over bins of logits, a clean text counting twice.

    0 if a class is missing; of equally good cuts the one in the middle.
    """
    if not clean.sum() or not toxic.sum():
        return 0.0
    over = 1 - np.concatenate([[0], np.cumsum(clean)]) / clean.sum()
    under = np.concatenate([[0], np.cumsum(toxic)]) / toxic.sum()
    wrong = 2 * over + under
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    return float(best[np.argmin(np.abs(best - np.median(best)))]) / BINS - LIMIT


#: Logits are counted from -LIMIT to LIMIT.
LIMIT = 30


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[Network | None, list]:
    """The trained network and the ids of the rows it was trained on."""
    counts, texts = class_counts(rows)
    if not texts.all():
        return None, []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = _tokens(batch.column("text"))
                ids = _ids(words)
                raw = [ids[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("label"), pa.array(raw, pa.binary())], ["doc_id", "label", "ids"]
                )

    chosen = bounded_sample(rows, sample).select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    local = chosen.mapInArrow(scan, "doc_id long, label int, ids binary").toArrow()
    labels, names = local.column("label").to_numpy(), local.column("doc_id").to_pylist()
    texts_ids = [np.frombuffer(x.as_py(), dtype=np.int32).reshape(-1, 2) for x in local.column("ids")]
    rng = np.random.default_rng(3)
    order = rng.permutation(len(labels))
    trained = order[len(order) // 4 :]  # the rest only helps to set the thresholds
    network = Network(counts, texts)
    for _ in range(EPOCHS):
        for i in rng.permutation(trained):
            network.learn(texts_ids[i], labels[i])
    return network, [names[i] for i in trained]


class _Scorer:
    """Logits and languages of the texts of a batch."""

    def __init__(self, network: Network) -> None:
        self.tables, self.out, self.bias = network.tables(), network.out.astype(np.float32), network.bias

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words = _tokens(batch.column("text"))
        logit = _pool_all(_ids(words), words.first, self.tables) @ self.out + self.bias
        return logit.astype(np.float64), _language(words)


def thresholds(docs: DataFrame, labels: DataFrame, label: str, scorer: _Scorer, trained: list) -> np.ndarray:
    """A cut per language (the last one for none) from all labelled rows but the ``trained`` ones.

    Texts are scored where they are; only ids and bins meet the labels, and only counts
    of bins, at most two a bin and language, reach the driver.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SCORE_BYTES):
                logit, language = scorer(batch)
                place = np.clip(np.floor((logit + LIMIT) * BINS), 0, 2 * LIMIT * BINS - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(language.astype(np.int64)), pa.array(place)], ["doc_id", "language", "bin"]
                )

    spark = docs.sparkSession
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, language long, bin long"
    )
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    seen = F.broadcast(spark.createDataFrame([(i,) for i in trained], "doc_id long"))
    counts = scored.join(known.join(seen, "doc_id", "left_anti"), "doc_id").groupBy("language", "label", "bin").agg(
        F.count(F.lit(1)).alias("n")
    ).toPandas()
    table = np.zeros((len(_LANGUAGES) + 1, 2, 2 * LIMIT * BINS))
    table[counts["language"], counts["label"], counts["bin"]] = counts["n"]
    overall = _threshold(*table.sum(0))
    return np.array([overall if t.sum(1).min() < FEW else _threshold(*t) for t in table])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; learns from the other folds.

    Texts are taken whole, however long.  Jobs for the fit and the thresholds run when
    called; scoring is row by row without a shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("held_out", "score", "predicted")
    own = labels.where(fold_of(folds) != held_out)
    network, trained = fit(labelled(docs, own, label, sample), sample)
    scorer = _Scorer(network) if network else None
    cuts = thresholds(docs, own, label, scorer, trained) if network else None
    schema = StructType([*docs.schema, StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SCORE_BYTES):
                if scorer:
                    logit, language = scorer(batch)
                    logit = logit - cuts[language]
                else:
                    logit = np.full(batch.num_rows, -1e-9)
                score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                columns = [batch.column(f.name).cast(f.type) for f in arrow if f.name != "score"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], schema=arrow)

    scored = docs.mapInArrow(scan, schema)
    return scored.select(
        *docs.columns,
        F.coalesce(fold_of(folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
