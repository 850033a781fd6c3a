"""Language-model scores from an Elias-Fano n-gram trie.

Levels are built one after the other, each by a Spark job that counts and a job that
writes shards of a range of keys to the shared folder:

1. Words: codes of all training tokens as an Elias-Fano sequence, with exact counts.  A
   word's id is its rank.
2. Pairs seen at least ``min_count[2]`` times: per first word a monotone pointer to its successors, their
   ids in fixed width, quantised discounted probabilities, and the quantised weight that
   is left to the lower order.
3. Triples seen at least ``min_count[3]`` times, in the same form below the pairs.

By default pairs seen once and triples seen once or twice are left to the lower order;
``min_count={2: 1, 3: 1}`` keeps every n-gram of the training texts, at the price of a
larger model.  A pair is only counted if both its words, and a triple if both its pairs,
are frequent enough, which loses none that would be kept.  Probabilities interpolate absolute
discounting down to the smoothed unigram, so they sum to one for every context.

Tasks map the level files into memory, so a model larger than memory is read by the page.
Files of a store that cannot be mapped are first copied to a nameless temporary file.

The last two tokens are searched context-relative: the pointer of the context gives a
range of the next level, and the word is searched in this range.

Defined results: null and empty texts are the end token alone; repeated rows count and
score each; a null id is never held out; without training rows N and V are 0; extra
columns pass through, columns of the result replace equally named ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from grainframe.llm.elias_fano import EliasFano, Packed, encode, pack_bits, search
from grainframe.llm.labelled import fold_of
from grainframe.llm.shared_files import map_file, write_file
from grainframe.llm.words import Words, slices, words_of
from grainframe.session import cut_lineage, scratch_path

END = 1
MIN_COUNT = {2: 2, 3: 3}
DISCOUNT = 0.75
#: Quantised log10 values: 255 steps of this size, downwards from 0.
STEP = 0.03
PENDING = 1_000_000
SHARD_ROWS = 2_000_000

ADDED = (
    "struct<n_tokens:bigint,n_known:bigint,train_tokens:bigint,base_score:double,score:double>"
)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every text's words and its end token, and where each text's begin."""
    first = words.first + np.arange(len(words) + 1)
    out = np.full(first[-1], END, dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[first[1:] - 1] = False
    out[inside] = (words.codes >> np.uint64(1)).astype(np.int64)
    return out, first


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-30)) / STEP), 0, 255).astype(np.uint8)


_VALUES = 10.0 ** (-STEP * np.arange(256))


@dataclass
class Level:
    """Where a level's shards are: file, first key, and the id of the first entry."""

    folder: str
    shards: list[tuple[str, int, int]]
    total: int


_OPEN: dict[tuple[str, str], object] = {}


def _opened(folder: str, name: str, reader):
    if (folder, name) not in _OPEN:
        if len(_OPEN) > 1024:
            _OPEN.clear()
        _OPEN[folder, name] = reader(map_file(folder, name))
    return _OPEN[folder, name]


class _WordShard:
    def __init__(self, data: np.ndarray) -> None:
        self.keys = EliasFano(data)
        self.counts = data[self.keys.size : self.keys.size + 8 * self.keys.n].view("<i8")


class _GramShard:
    """Successors of a range of parents."""

    def __init__(self, data: np.ndarray) -> None:
        self.low, parents, n, width, child_bytes = (int(x) for x in data[:40].view("<i8"))
        at = 40
        self.pointers = EliasFano(data[at:])
        at += self.pointers.size
        self.children = Packed(data[at : at + child_bytes], width)
        at += child_bytes
        self.rest = data[at : at + parents]
        self.p = data[at + parents : at + parents + n]
        at += parents + n
        at += -at % 8
        self.counts = data[at : at + 4 * n].view("<u4")
        self.parents = parents

    def ranges(self, parent: np.ndarray) -> tuple[np.ndarray, ...]:
        """First and end of each parent's successors, and the weight left to the lower order."""
        at = parent - self.low
        known = (at >= 0) & (at < self.parents)
        at = np.where(known, at, 0)
        start = self.pointers[at].astype(np.int64)
        end = np.where(known, self.pointers[at + 1].astype(np.int64), start)
        return start, end, np.where(end > start, _VALUES[self.rest[at]], 1.0)


def _by_shard(level: Level, keys: np.ndarray) -> Iterator[tuple[str, int, np.ndarray]]:
    firsts = np.array([s[1] for s in level.shards], dtype=np.int64)
    which = np.searchsorted(firsts, keys, side="right") - 1
    for s in np.unique(which[which >= 0]):
        yield level.shards[s][0], level.shards[s][2], np.flatnonzero(which == s)


def word_ids(level: Level, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id (or -1) and exact count of each different key, and for each key which of these it is."""
    unique, where = np.unique(keys, return_inverse=True)
    ids, counts = np.full(len(unique), -1, dtype=np.int64), np.zeros(len(unique), dtype=np.int64)
    for name, base, at in _by_shard(level, unique):
        shard = _opened(level.folder, name, _WordShard)
        found = shard.keys.find(unique[at])
        hit = found >= 0
        ids[at[hit]] = found[hit] + base
        counts[at[hit]] = shard.counts[found[hit]]
    return ids, counts, where


def grams(
    level: Level, parents: np.ndarray, child: np.ndarray, where: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Entry id (or -1), discounted probability, weight of the lower order, and count of each pair.

    A pair's parent is ``parents[where]``, none where ``where`` is -1; without ``where``
    there is one parent for each child.  Pointers are followed once for each parent.
    """
    n = len(child)
    where = np.arange(n) if where is None else where
    ids, p, rest = np.full(n, -1, dtype=np.int64), np.zeros(n), np.ones(n)
    counts = np.zeros(n, dtype=np.int64)
    for name, base, at in _by_shard(level, parents):
        at = at[parents[at] >= 0]
        shard = _opened(level.folder, name, _GramShard)
        start, end, left = shard.ranges(parents[at])
        local = np.full(len(parents) + 1, -1, dtype=np.int64)
        local[at] = np.arange(len(at))
        of = local[where]  # -1 reads the spare last place
        mine = np.flatnonzero(of >= 0)
        of, wanted = of[mine], child[mine]
        rest[mine] = left[of]
        # an unknown word still leaves the context's weight to the lower order
        stop = np.where(wanted >= 0, end[of], start[of])
        found = search(shard.children, start[of], stop, np.maximum(wanted, 0).astype(np.uint64))
        hit = found >= 0
        ids[mine[hit]] = found[hit] + base
        p[mine[hit]] = _VALUES[shard.p[found[hit]]]
        counts[mine[hit]] = shard.counts[found[hit]]
    return ids, p, rest, counts


def counts_of(level: Level, ids: np.ndarray, reader) -> np.ndarray:
    """Counts of entries given by id, for shards that ``reader`` opens."""
    bases = np.array([s[2] for s in level.shards], dtype=np.int64)
    which = np.searchsorted(bases, ids, side="right") - 1
    out = np.zeros(len(ids), dtype=np.int64)
    for s in np.unique(which):
        at = np.flatnonzero(which == s)
        name, _, base = level.shards[s]
        out[at] = _opened(level.folder, name, reader).counts[ids[at] - base]
    return out


def _context_pairs(ids: np.ndarray, first: np.ndarray, back: int) -> np.ndarray:
    """For each token the id ``back`` places before it in its text, or -1."""
    out = np.full(len(ids), -1, dtype=np.int64)
    out[back:] = ids[:-back] if len(ids) > back else ids[:0]
    for k in range(back):
        at = first[:-1] + k
        out[at[at < np.minimum(first[1:], len(ids))]] = -1
    return out


def _count(docs: DataFrame, keys_of, names: list[str]) -> DataFrame:
    """Sums of what ``keys_of`` finds in each slice, added up in the task before they are sent."""

    def add(parts: list) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        if len(columns) == 3 and not ((columns[0] | columns[1]) >> 31).any():  # ids that fit one sort key
            order = np.argsort((columns[0] << 32) | columns[1])
        else:
            order = np.lexsort(columns[-2::-1])
        columns = [c[order] for c in columns]
        fresh = np.ones(len(order), dtype=bool)
        if len(order):
            fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
        lead = np.flatnonzero(fresh)
        sums = np.add.reduceat(columns[-1], lead) if len(lead) else columns[-1][:0]
        return pa.RecordBatch.from_arrays([pa.array(c[lead]) for c in columns[:-1]] + [pa.array(sums)], [*names, "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, pending = [], 0
        for whole in batches:
            for batch in slices(whole, "text"):
                found = keys_of(*_tokens(words_of(batch.column("text"))))
                parts.append(found)
                pending += len(found[0])
                if pending >= PENDING:
                    yield add(parts)
                    parts, pending = [], 0
        if parts:
            yield add(parts)

    schema = ", ".join(f"{x} long" for x in names) + ", n long"
    return docs.select("text").mapInArrow(scan, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def _write_level(rows: DataFrame, key: str, columns: list[str], build, folder: str, label: str) -> Level:
    """Shards by ranges of ``key``; ``build`` makes a shard's parts from its sorted columns."""
    rows = cut_lineage(rows, label)
    total = rows.count()
    width = max(1, math.ceil(total / SHARD_ROWS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[b.column(c).to_numpy() for c in columns] for b in batches if b.num_rows]
        if not got:
            return
        arrays = [np.concatenate(c) for c in zip(*got)]
        context = TaskContext.get()
        name = f"{label}-{context.partitionId():06d}"
        write_file(folder, name, build(*arrays), context.taskAttemptId())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([int(arrays[0][0])]), pa.array([len(arrays[0])])], ["file", "first", "n"]
        )

    sorted_rows = rows.repartitionByRange(width, key).sortWithinPartitions(*columns[:2])
    made = cut_lineage(
        sorted_rows.select(*columns).mapInArrow(scan, "file string, first long, n long"), f"{label}-files"
    )
    shards, base = [], 0
    for r in made.orderBy("first").collect():
        shards.append((r["file"], r["first"], base))
        base += r["n"]
    return Level(folder, shards, total)


def _build_words(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    return [encode(keys), counts.astype("<i8").tobytes()]


def _build_grams(parent: np.ndarray, child: np.ndarray, n: np.ndarray, count_of) -> list[bytes]:
    """A shard; ``count_of`` gives the counts of the parents it is asked for."""
    fresh = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
    total = np.repeat(count_of(parent[fresh]), np.diff(np.append(fresh, len(parent))))
    low, parents = int(parent[0]), int(parent[-1] - parent[0]) + 1
    p = (n - DISCOUNT) / total
    pointers = np.searchsorted(parent, low + np.arange(parents + 1))
    quantised = _quantise(p)
    sums = np.concatenate([[0.0], np.cumsum(_VALUES[quantised])])
    rest = _quantise(np.maximum(1 - (sums[pointers[1:]] - sums[pointers[:-1]]), 1e-3))
    width = max(1, int(child.max()).bit_length())
    children = pack_bits(child, width)
    children += bytes(-len(children) % 8)
    parts = [
        np.array([low, parents, len(child), width, len(children)], dtype="<i8").tobytes(),
        encode(pointers), children, rest.tobytes(), quantised.tobytes(),
    ]
    parts.append(bytes(-sum(map(len, parts)) % 8))
    return [*parts, np.minimum(n, 2**32 - 1).astype("<u4").tobytes()]


@dataclass
class Model:
    words: Level
    pairs: Level
    triples: Level
    tokens: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed unigram probabilities."""
        return (counts + 0.1) / (self.tokens + 0.1 * (self.words.total + 1))

    def probabilities(self, keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Count, unigram probability and the model's probability of each token."""
        words, counts, where = word_ids(self.words, keys)
        ids, base = words[where], self.base(counts)[where]
        entry, p2, rest2, _ = grams(self.pairs, words, ids, _context_pairs(where, first, 1))
        p = p2 + rest2 * base
        context = _context_pairs(entry, first, 1)  # the pair that ends before the token
        _, p3, rest3, _ = grams(self.triples, context, ids)
        return counts[where], base, p3 + rest3 * p


def train(docs: DataFrame, folder: str | None = None, min_count: Mapping[int, int] = MIN_COUNT) -> Model:
    """Counts the n-grams of ``docs`` and writes the trie below ``folder``."""
    folder = folder or scratch_path(docs.sparkSession, "trie")

    def one(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        return np.unique(keys, return_counts=True)

    counted = cut_lineage(_count(docs, one, ["word"]), "words")
    tokens = counted.agg(F.sum("n")).first()[0] or 0
    words = _write_level(counted, "word", ["word", "n"], _build_words, folder, "word-level")

    def two(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        ids, counts, where = word_ids(words, keys)
        ids = np.where(counts >= min_count[2], ids, -1)[where]
        before = _context_pairs(ids, first, 1)
        kept = (before >= 0) & (ids >= 0)
        return before[kept], ids[kept], np.ones(np.count_nonzero(kept), dtype=np.int64)

    def pair_shard(*columns: np.ndarray) -> list[bytes]:
        return _build_grams(*columns, lambda parents: counts_of(words, parents, _WordShard))

    columns = ["parent", "child", "n"]
    pair_rows = _count(docs, two, ["parent", "child"]).where(F.col("n") >= min_count[2])
    pairs = _write_level(pair_rows, "parent", columns, pair_shard, folder, "pair-level")

    def three(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        found, _, where = word_ids(words, keys)
        ids = found[where]
        entry, _, _, later = grams(pairs, found, ids, _context_pairs(where, first, 1))
        context = _context_pairs(entry, first, 1)
        total = np.concatenate([[0], later[:-1]])
        kept = (context >= 0) & (total >= min_count[3]) & (later >= min_count[3])
        return context[kept], ids[kept], np.ones(np.count_nonzero(kept), dtype=np.int64)

    def triple_shard(*columns: np.ndarray) -> list[bytes]:
        return _build_grams(*columns, lambda parents: counts_of(pairs, parents, _GramShard))

    triple_rows = _count(docs, three, ["parent", "child"]).where(F.col("n") >= min_count[3])
    triples = _write_level(triple_rows, "parent", columns, triple_shard, folder, "triple-level")
    return Model(words, pairs, triples, tokens)


def score_texts(
    docs: DataFrame, folds: int = 10, held_out: int = 0, min_count: Mapping[int, int] = MIN_COUNT
) -> DataFrame:
    """``docs`` with ``held_out`` and the scores; learns from the other folds.

    ``min_count`` says how often pairs and triples must occur to be kept; 1 keeps all.
    Runs the training jobs when called; scoring is row by row without a shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = _parse_datatype_string(ADDED)
    made = {f.name for f in added}
    docs = docs.drop("held_out", *made).withColumn(
        "held_out", F.coalesce(fold_of(folds) == held_out, F.lit(False))
    )
    model = train(docs.where("not held_out"), min_count=min_count)
    schema = StructType([*docs.schema, *added])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, first = _tokens(words_of(batch.column("text")))
                counts, base, p = model.probabilities(keys, first)
                per_text = {
                    "n_tokens": np.diff(first),
                    "n_known": np.add.reduceat(counts > 0, first[:-1], dtype=np.int64),
                    "train_tokens": np.full(batch.num_rows, model.tokens, dtype=np.int64),
                    "base_score": np.add.reduceat(np.log10(base), first[:-1]),
                    "score": np.add.reduceat(np.log10(p), first[:-1]),
                }
                columns = [
                    pa.array(per_text[f.name]) if f.name in per_text else batch.column(f.name).cast(f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(scan, schema)
