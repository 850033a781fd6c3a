"""SimHash fingerprints and the components of those that differ in few bits.

Fingerprints are made in numpy over Arrow batches: XXH64 of all shingles of one length
at a time, bits counted in eight byte lanes of a word at once.

Pairs within ``BITS`` differing bits are found by pigeonring filtering over SEGMENTS
segments laid in a ring.  Such a pair has a segment from which every chain of ``l``
consecutive segments differs in at most ``l * BITS / SEGMENTS`` bits.  With five segments
the first segment is therefore equal and the next holds one difference at most: this
chain of two is the key (the second segment with one bit masked), and longer chains
prune the pairs of a key before the full distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.llm.components import components
from grainframe.llm.words import WHOLE, slices, utf8
from grainframe.session import cut_lineage

SIZE = 4
SEED = 42
BITS = 4
#: Widths of the ring's segments, one more than BITS, from the lowest bit upwards.
SEGMENTS = (13, 13, 13, 13, 12)
#: Fingerprints of a key that are compared with each other; larger keys take ``_ball`` links.
KEY_LIMIT = 1024

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)  # fixed values of XXH64
    for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_U = np.uint64
_LANES = _U(0x0101010101010101)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _round(lane: np.ndarray) -> np.ndarray:
    return _turn(lane * _P2, 31) * _P1


def _xxh64(data: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """XXH64 of the ``size`` bytes from each place ``at``; ``data`` has 8 spare bytes at its end."""
    eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
    four = np.lib.stride_tricks.as_strided(data[:4].view("<u4"), (len(data) - 7,), (1,))
    start = [(seed + int(_P1) + int(_P2)), seed + int(_P2), seed, seed - int(_P1)]
    done = 0
    if size >= 32:
        lanes = [np.full(len(at), v % 2**64, dtype=np.uint64) for v in start]
        while size - done >= 32:
            for k in range(4):
                lanes[k] = _turn(lanes[k] + eight[at + (done + 8 * k)] * _P2, 31) * _P1
            done += 32
        h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for v in lanes:
            h = (h ^ _round(v)) * _P1 + _P4
    else:
        h = np.full(len(at), seed + int(_P5), dtype=np.uint64)
    h = h + _U(size)
    while size - done >= 8:
        h = _turn(h ^ _round(eight[at + done]), 27) * _P1 + _P4
        done += 8
    if size - done >= 4:
        h = _turn(h ^ (four[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
        done += 4
    for k in range(done, size):
        h = _turn(h ^ (data[at + k].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def xxh64(data: np.ndarray, at: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many byte runs of one buffer; lengths that occur rarely go to the library."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    order = np.argsort(size, kind="stable")
    sizes, first, counts = np.unique(size[order], return_index=True, return_counts=True)
    out = np.empty(len(at), dtype=np.uint64)
    for length, low, n in zip(sizes, first, counts):
        rows = order[low : low + n]
        if n < 32 or length > 512:
            for r in rows:
                out[r] = xxhash.xxh64_intdigest(data[at[r] : at[r] + length].tobytes(), seed=seed)
        else:
            out[rows] = _xxh64(padded, at[rows], int(length), seed)
    return out


def _shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Space-joined words of all texts as bytes, and each shingle's place, length and text number."""
    data, text_at = utf8(column)
    inside = WHOLE[data] > 0
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    border = text_at[(text_at > 0) & (text_at < len(data))]
    begin[border] = inside[border]
    finish[border - 1] = inside[border - 1]
    starts = np.flatnonzero(begin)
    sizes = np.flatnonzero(finish) + 1 - starts
    joined = np.full(int(sizes.sum()) + len(sizes), 0x20, dtype=np.uint8)
    place = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
    joined[place] = _FOLD[data[inside]]
    ends = np.cumsum(sizes + 1) - 1
    words = np.searchsorted(starts, text_at)
    counts = np.diff(words)
    per_text = np.where(counts > 0, np.maximum(counts - SIZE + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(int(per_text.sum())) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    head = words[:-1][text] + nth
    tail = np.minimum(head + SIZE, words[1:][text]) - 1
    at = ends[head] - sizes[head]
    return joined, at, ends[tail] - at, text


def fingerprints_of(column: pa.Array) -> np.ndarray:
    """64-bit fingerprint of each text; zero where there is no word."""
    joined, at, size, text = _shingles(column)
    ones = np.zeros((len(column), 64), dtype=np.int64)
    total = np.bincount(text, minlength=len(column))
    if len(at):
        hashes = xxh64(joined, at, size)
        # runs of at most 255 shingles of one text, so that a byte lane cannot overflow
        nth = np.arange(len(text)) - (np.cumsum(total) - total)[text]
        runs = np.flatnonzero(nth % 255 == 0)
        for shift in range(8):
            lanes = np.add.reduceat((hashes >> _U(shift)) & _LANES, runs)
            np.add.at(ones[:, shift::8], text[runs], lanes.astype("<u8").view(np.uint8).reshape(-1, 8))
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _segments() -> list[tuple[int, int]]:
    low = np.cumsum((0, *SEGMENTS))
    return [(int(a), int(w)) for a, w in zip(low, SEGMENTS)]


def _segment(x: np.ndarray, k: int) -> np.ndarray:
    low, width = _segments()[k % len(SEGMENTS)]
    return (x >> _U(low)) & _U((1 << width) - 1)


def ring_keys(prints: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint: start segment, its value, the next with one bit masked; a row each."""
    keys = []
    for start in range(len(SEGMENTS)):
        head, after = _segment(prints, start), _segment(prints, start + 1)
        for bit in range(SEGMENTS[(start + 1) % len(SEGMENTS)]):
            keys.append(_U(start << 32 | bit << 28) | (head << _U(13)) | (after & ~_U(1 << bit)))
    return np.stack(keys, axis=1)


def ring_links(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each pair holds the budget of every chain from its start, the last being all 64 bits."""
    diff = a ^ b
    each = np.stack([np.bitwise_count(_segment(diff, k)) for k in range(len(SEGMENTS))], axis=1).astype(np.int16)
    kept = np.arange(len(a))
    total = np.zeros(len(a), dtype=np.int16)
    for length in range(1, len(SEGMENTS) + 1):
        total = total + each[kept, (start[kept] + length - 1) % len(SEGMENTS)]
        within = total <= length * BITS // len(SEGMENTS)
        kept, total = kept[within], total[within]
    out = np.zeros(len(a), dtype=bool)
    out[kept] = True
    return out


def _spanning(prints: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join the fingerprints of one key as far as they hang together, at most one less than these."""
    label = np.arange(len(prints))
    for i in range(len(prints) - 1):
        other = np.arange(i + 1, len(prints))
        other = other[label[other] != label[i]]
        hit = other[ring_links(np.full(len(other), prints[i]), prints[other], np.full(len(other), start))]
        joined, one_each = np.unique(label[hit], return_index=True)
        if len(joined):
            yield np.full(len(joined), prints[i]), prints[hit[one_each]]
            label[np.isin(label, joined)] = label[i]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(prints), 20_000):
            part = prints[low : low + 20_000]
            keys = ring_keys(part)
            yield pa.record_batch(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part, keys.shape[1]).view(np.int64))],
                names=["key", "print"],
            )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within lists of fingerprints that share a key."""
    for batch in batches:
        keys, lists = batch.column("key").to_numpy(), batch.column("prints")
        prints = lists.flatten().to_numpy().view(np.uint64)
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sizes, starts = np.diff(first), (keys >> 32).astype(np.int64)
        found = [(np.zeros(0, dtype=np.uint64),) * 2]
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size > 48:
                for r in rows:
                    found.extend(_spanning(prints[first[r] : first[r + 1]], starts[r]))
                continue
            i, j = np.triu_indices(size, 1)
            for low in range(0, len(rows), max(1, 500_000 // max(1, len(i)))):
                some = rows[low : low + max(1, 500_000 // max(1, len(i)))]
                table = prints[first[some][:, None] + np.arange(size)]
                a, b = table[:, i].ravel(), table[:, j].ravel()
                hit = ring_links(a, b, np.repeat(starts[some], len(i)))
                found.append((a[hit], b[hit]))
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def _ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every value within BITS / 2 bits of each fingerprint."""
    flips = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i in range(64) for j in range(i))]
    flips = np.array(flips, dtype=np.uint64)
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(prints), 500):
            part = prints[low : low + 500]
            yield pa.record_batch(
                [
                    pa.array((part[:, None] ^ flips).ravel().view(np.int64)),
                    pa.array(np.repeat(part, len(flips)).view(np.int64)),
                ],
                names=["value", "print"],
            )


def near_links(prints: DataFrame, key_limit: int = KEY_LIMIT) -> DataFrame:
    """``a, b`` of distinct fingerprints (one long column) so that links within BITS bits connect the same.

    Keys with up to ``key_limit`` fingerprints are compared inside; of a large list only
    links that join its parts are given.  The fingerprints of larger keys each list the
    values within two bits: two fingerprints are within four bits exactly if they share
    such a value, so linking each to the least one of the value is exact, linear in their
    number, and makes no pairs.
    """
    prints = prints.toDF("print")
    keyed = prints.mapInArrow(_keyed, "key long, print long")
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > key_limit)
    crowded = cut_lineage(crowded.select("key"), "simhash-crowded")
    usual = keyed.join(crowded, "key", "left_anti").groupBy("key").agg(F.collect_list("print").alias("prints"))
    links = usual.where(F.size("prints") > 1).mapInArrow(_compared, "a long, b long")
    ball = keyed.join(crowded, "key", "left_semi").select("print").distinct().mapInArrow(_ball, "value long, print long")
    nearest = ball.groupBy("value").agg(F.min("print").alias("a"))
    ball_links = ball.join(nearest, "value").where("print <> a").select("a", F.col("print").alias("b"))
    return links.unionByName(ball_links)


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            prints = fingerprints_of(part.column("text")).view(np.int64)
            yield pa.record_batch([part.column("doc_id"), pa.array(prints)], names=["doc_id", "print"])


def simhash_hex(value: Column) -> Column:
    """A fingerprint held as a long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def simhash_groups(docs: DataFrame, key_limit: int = KEY_LIMIT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Whole texts are lower-cased (A-Z) and cut into words and space-joined four-word
    shingles, repeats included; fewer words are one shingle.  A bit is 1 if it is set in
    more than half the XXH64 values (seed 42).  Rows whose fingerprints differ in four
    bits or fewer are linked; ``component_id`` is the smallest ``doc_id`` reachable.

    Null and empty texts have fingerprint zero and are linked like any other.  Rows with
    a null ``doc_id`` link and bridge; their component is the smallest id reachable, null
    if there is none.  Repeated rows are kept each.  Columns not named are left out.  A
    very long text is taken whole, by itself.  Copies meet as one fingerprint, so a group
    with a third of all rows is pre-aggregated before any shuffle of keys.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    printed = docs.select("doc_id", "text").mapInArrow(_printed, f"doc_id {kind}, print long")
    printed = cut_lineage(printed, "simhash-prints")
    least = cut_lineage(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-least")
    grouped = components(near_links(least.select("print"), key_limit))
    placed = least.join(grouped, F.col("print") == F.col("node"), "left").withColumn(
        "root", F.coalesce("component", "print")
    )
    roots = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = placed.select("print", "root").join(roots, "root").select("print", "component_id")
    return printed.join(labels, "print").select("doc_id", simhash_hex(F.col("print")).alias("fingerprint"), "component_id")
