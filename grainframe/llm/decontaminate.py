"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over the whole corpus give IDF weights.
2. Benchmark items are cut into passages, of which the rarer half of the words counts,
   however frequent: an item that a third of all documents hold is found too.  A
   randomised SVD of their TF-IDF matrix runs
   as Spark jobs: each range-finder step sums ``A'(A Q)`` by word, so only a matrix of
   words of one block by ``RANK`` reaches the driver.
3. Every text is read in overlapping windows.  Of those whose squared weights come to
   ``MASS`` of the lightest passage's, the latent vector is compared with all passages;
   cosines of at least ``COSINE`` make a candidate.
4. Candidates are checked on words of the text around the window.  A verbatim run of
   ``RUN`` words of the item (of a shorter item, all of it) is a leak by itself, whatever
   part of the item it is.  Paraphrases are judged by the longest common subsequence with
   the whole item, and with the item's end, which holds its answer.

The benchmark goes through in blocks of ``BLOCK_ITEMS`` items, one pass over the
documents each, so what a task holds does not grow with either side.

Defined results: null or empty texts have no leaks; null or empty items leak nowhere;
repeated rows and rows without an id are treated alike; a very long text is read whole, in
windows; extra columns pass through, an equally named ``leaks`` is replaced; an empty
benchmark gives empty lists.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from grainframe.llm.words import Words, slices, words_of
from grainframe.session import cut_lineage

BUCKETS = 1 << 18
PASSAGE, STRIDE = 24, 6
RANK = 64
COSINE = 0.6
MASS = 0.4
OVERLAP = 0.6
ANSWER = 0.34
RUN = 13
BLOCK_ITEMS = 4096

LEAKS = (
    "array<struct<item_id:bigint,cosine:double,overlap:double,answer:double,"
    "run:bigint,start:bigint,end:bigint>>"
)


def _words(column: pa.Array) -> Words:
    """Words in lower case, whatever the script."""
    return words_of(pc.utf8_lower(column))


def _buckets(codes: np.ndarray) -> np.ndarray:
    return (codes % np.uint64(BUCKETS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each word bucket occurs, and the number of documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                words = _words(batch.column("text"))
                pairs = np.unique(words.owner() * BUCKETS + _buckets(words.codes))
                total += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
                n += batch.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], ["bucket", "n"]
        )

    counts = docs.select("text").mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")
    ).toPandas()
    found, documents = np.zeros(BUCKETS, dtype=np.int64), 0
    for_word = counts["bucket"] >= 0
    found[counts.loc[for_word, "bucket"]] = counts.loc[for_word, "n"]
    documents = int(counts.loc[~for_word, "n"].sum())
    return found, documents


def _weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    return (np.log((documents + 1) / (frequency + 1)) + 1).astype(np.float32)


def _passages(n: int) -> list[tuple[int, int]]:
    """Windows of an item with ``n`` words; the last one ends with the item."""
    if n <= PASSAGE:
        return [(0, n)]
    return [(s, s + PASSAGE) for s in range(0, n - PASSAGE, STRIDE)] + [(n - PASSAGE, n)]


class _Basis:
    """Words of a benchmark block as rows of a matrix: bucket to row, row to weight."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray) -> None:
        self.row_of = np.full(BUCKETS, -1, dtype=np.int32)
        self.row_of[buckets] = np.arange(len(buckets), dtype=np.int32)
        self.weight = weights[buckets].astype(np.float64)

    def entries(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words of the block, and their rows."""
        rows = self.row_of[_buckets(codes)]
        at = np.flatnonzero(rows >= 0)
        return at, rows[at]


def _step(items: DataFrame, basis: _Basis, matrix: np.ndarray, square: bool) -> np.ndarray:
    """``A'(A M)`` by word, or ``(A M)'(A M)``, summed over the passages of all items."""
    rank = matrix.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank if square else len(matrix), rank))
        for batch in batches:
            words = _words(batch.column("text"))
            for low, high in zip(words.first[:-1], words.first[1:]):
                for start, end in _passages(int(high - low)):
                    _, rows = basis.entries(words.codes[low + start : low + end])
                    if not len(rows):
                        continue
                    rows, times = np.unique(rows, return_counts=True)
                    value = times * basis.weight[rows]
                    value /= np.linalg.norm(value)
                    latent = value @ matrix[rows]
                    if square:
                        total += np.outer(latent, latent)
                    else:
                        total[rows] += value[:, None] * latent
        some = np.flatnonzero(np.abs(total).sum(1))
        flat = pa.array(total[some].ravel())
        at = pa.array(np.arange(0, len(some) * rank + 1, rank, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.ListArray.from_arrays(at, flat)], ["row", "v"]
        )

    parts = items.select("text").mapInArrow(scan, "row long, v array<double>")
    sums = parts.groupBy("row").agg(
        F.aggregate(
            F.collect_list("v"), F.array_repeat(F.lit(0.0), rank),
            lambda total, v: F.zip_with(total, v, lambda a, b: a + b),
        ).alias("v")
    ).toPandas()
    out = np.zeros((rank if square else len(matrix), rank))
    if len(sums):
        out[sums["row"].to_numpy()] = np.stack(sums["v"].to_numpy())
    return out


def latent_words(items: DataFrame, basis: _Basis, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Word vectors of the leading right singular space of the passages, by randomised SVD."""
    width = min(rank, len(basis.weight))
    matrix = np.random.default_rng(seed).standard_normal((len(basis.weight), width))
    for _ in range(2):
        matrix = np.linalg.qr(_step(items, basis, matrix, square=False))[0]
    _, vectors = np.linalg.eigh(_step(items, basis, matrix, square=True))
    return (matrix @ vectors[:, ::-1]).astype(np.float32)


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, a machine word of ``a`` at a time."""
    places: dict = defaultdict(int)
    for i, x in enumerate(a):
        places[x] |= 1 << i
    mask = (1 << len(a)) - 1
    row = mask
    for y in b:
        met = row & places.get(y, 0)
        row = ((row + met) | (row - met)) & mask
    return len(a) - row.bit_count()


def verbatim_run(item: list, region: list, least: int = RUN) -> int:
    """Words of the longest stretch of ``region`` made of ``least``-word runs of ``item``; 0 if there is none.

    An item with fewer words must stand there whole.
    """
    size = min(least, len(item))
    runs = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)}
    best = streak = 0
    for i in range(len(region) - size + 1):
        streak = streak + 1 if tuple(region[i : i + size]) in runs else 0
        best = max(best, streak)
    return best + size - 1 if best else 0


class _Block:
    """One benchmark block: passages in latent space and the items' words."""

    def __init__(self, ids: list, codes: list[np.ndarray], basis: _Basis, vectors: np.ndarray) -> None:
        self.basis, self.vectors = basis, vectors * basis.weight[:, None].astype(np.float32)
        self.ids, self.codes = ids, [c.tolist() for c in codes]
        owner, latent, masses = [], [], []
        for i, c in enumerate(codes):
            for start, end in _passages(len(c)):
                rows = basis.entries(c[start:end])[1]
                v = self.vectors[rows].sum(0)
                masses.append(float((basis.weight[rows] ** 2).sum()))
                if (norm := np.linalg.norm(v)) > 0:
                    owner.append(i)
                    latent.append(v / norm)
        self.least = MASS * min(masses)
        self.owner = np.array(owner, dtype=np.int64)
        self.latent = np.array(latent, dtype=np.float32).reshape(-1, vectors.shape[1])

    def leaks(self, codes: np.ndarray) -> list[dict]:
        """Leaks of one text given by its word codes."""
        at, rows = self.basis.entries(codes)
        if not len(at):
            return []
        mass = np.concatenate([[0.0], np.cumsum(self.basis.weight[rows] ** 2)])
        if mass[-1] < self.least:
            return []
        last = max(0, -(-(len(codes) - PASSAGE) // STRIDE))
        first = np.maximum(0, (at - PASSAGE) // STRIDE + 1)
        starts = np.unique(np.concatenate([first + k for k in range(-(-PASSAGE // STRIDE))]))
        starts = starts[starts <= last] * STRIDE
        low, high = np.searchsorted(at, starts), np.searchsorted(at, starts + PASSAGE)
        kept = mass[high] - mass[low] >= self.least
        starts, low, high = starts[kept], low[kept], high[kept]
        found: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for lo in range(0, len(starts), 4096):
            some = slice(lo, lo + 4096)
            a, b = low[some], high[some]
            base = a[0] if len(a) else 0
            sums = np.zeros((b.max() - base + 1, self.latent.shape[1]), dtype=np.float32)
            np.cumsum(self.vectors[rows[base : b.max()]], axis=0, out=sums[1:])
            window = sums[b - base] - sums[a - base]
            norm = np.linalg.norm(window, axis=1, keepdims=True)
            window = (window / np.maximum(norm, 1e-9)).astype(np.float32)
            for k in range(0, len(self.latent), 4096):
                cosine = window @ self.latent[k : k + 4096].T
                w, p = np.nonzero(cosine >= COSINE)
                for i, j in zip(w.tolist(), p.tolist()):
                    found[self.owner[k + j]].append((int(starts[some][i]), float(cosine[i, j])))
        out = []
        for item in sorted(found):
            mine, best = self.codes[item], None
            for start, end, cosine in self._regions(sorted(found[item]), len(mine), len(codes)):
                region = codes[start:end].tolist()
                overlap, run = common_subsequence(mine, region) / len(mine), verbatim_run(mine, region)
                if overlap < OVERLAP and not run:
                    continue
                tail = mine[-max(1, len(mine) // 4) :]
                answer = common_subsequence(tail, region) / len(tail)
                if (run or answer >= ANSWER) and (best is None or (overlap, run) > (best["overlap"], best["run"])):
                    best = {
                        "item_id": self.ids[item], "cosine": cosine, "overlap": overlap,
                        "answer": answer, "run": run, "start": start, "end": end,
                    }
            if best:
                out.append(best)
        return out

    def _regions(self, hits: list[tuple[int, float]], size: int, n: int) -> Iterator[tuple[int, int, float]]:
        """Stretches around windows near each other, an item's length to either side."""
        low, high, cosine = hits[0][0], hits[0][0], 0.0
        for start, value in [*hits, (n + 2 * (size + PASSAGE), 0.0)]:
            if start - high > size:
                yield max(0, low - size), min(n, high + PASSAGE + size), cosine
                low, cosine = start, 0.0
            high, cosine = start, max(cosine, value)


def _blocks(benchmark: DataFrame, weights: np.ndarray, block_items: int) -> Iterator[_Block]:
    items = benchmark.where("item_id is not null and trim(text) <> ''").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    ).distinct()
    count = items.count()
    parts = -(-count // block_items)
    items = cut_lineage(
        items.withColumn("block", F.expr(f"pmod(xxhash64(item_id), {max(1, parts)})")), "items"
    )
    for part in range(parts):
        block = items.where(F.col("block") == part)
        local = block.orderBy("item_id", "text").select("item_id", "text").toArrow()
        if not local.num_rows:
            continue
        words = _words(local.column("text").combine_chunks())
        kept = np.flatnonzero(np.diff(words.first))
        codes = [words.codes[words.first[i] : words.first[i + 1]] for i in kept]
        ids = local.column("item_id").to_pylist()
        rare = set()
        for c in codes:
            for start, end in _passages(len(c)):
                mine = np.unique(_buckets(c[start:end]))
                mine = mine[np.argsort(-weights[mine], kind="stable")]
                rare.update(mine[: -(-len(mine) // 2)].tolist())
        used = np.array(sorted(rare), dtype=np.int64)
        if len(codes):
            basis = _Basis(used, weights)
            yield _Block([ids[i] for i in kept], codes, basis, latent_words(block, basis))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` with a list ``leaks`` of benchmark items that each text holds.

    Runs jobs over corpus frequencies and the benchmark when called; the search itself
    is row by row without a shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("leaks")
    frequency, documents = document_frequencies(docs)
    weights = _weights(frequency, documents)
    leaks = _parse_datatype_string(LEAKS)
    schema = StructType([*docs.schema, StructField("leaks", leaks)])
    arrow = to_arrow_schema(schema)
    out = docs.withColumn("leaks", F.array().cast(leaks))

    def searcher(block: _Block):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    words = _words(batch.column("text"))
                    before = batch.column("leaks").to_pylist()
                    after = [
                        old + block.leaks(words.codes[a:b])
                        for old, a, b in zip(before, words.first[:-1], words.first[1:])
                    ]
                    columns = [
                        batch.column(f.name).cast(f.type) if f.name != "leaks" else pa.array(after, f.type)
                        for f in arrow
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        return scan

    for block in _blocks(benchmark, weights, block_items):
        out = out.mapInArrow(searcher(block), schema)
    return out
