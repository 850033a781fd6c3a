"""Exact Jaccard self-join of documents on word shingles by several global token orders.

A document's set is its distinct five-word shingles.  Two sets whose Jaccard similarity
reaches ``t`` must share a token within their prefixes, whatever global token order the
prefix is taken from.  Here every order puts tokens of few documents first and breaks
ties by its own hash; the first order gives candidates, the others must agree before
two sets are compared in full.

1. Equal sets become one set (a 64-bit digest); everything else is about distinct sets.
2. In how many sets a token occurs is found in shards: each map task sends every shard
   its token codes packed by document.  A token that several documents of a task share
   is sent once with their number, so one that a third of all documents hold arrives once
   per task.  Back come, for each set, how many of its tokens others hold too, and the
   tokens held by more than ``1/FREQUENT`` of all token entries: at most FREQUENT, so
   that table is bounded and goes to every task as the frequency part of the orders.
3. A set whose tokens are mostly its own cannot reach ``t`` with another; only the
   remaining sets fetch their texts, by id or by digest, form prefixes and post them.
4. In the first round each posted token links its sets to one anchor, the set with the
   least of its own tokens; the second round compares what is posted under the same
   token but still lies in different components.  Pairs within a component are never
   formed, nor are those that a parity bitmap of the sets rules out: the bits in which
   two bitmaps differ are no more than the tokens in which the sets differ.

Step 2 cuts tokens to 32 bits within a shard; a collision makes a token look shared,
which lets more sets pass and never loses one.

Defined results: null, empty and white-space texts have the empty set and link with
nothing; repeated rows share a component; rows with a null id link
and bridge like others and have a null component when no row with an id is reached; extra
columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.llm.components import components
from grainframe.llm.words import mix, shingle_sets, slices, words_of
from grainframe.session import cut_lineage

#: Token codes a shard holds at a time, about.
SHARD_TOKENS = 2_000_000
#: Token codes a map task gathers before it sends them, about.
SLICE_TOKENS = 1_000_000
#: Sets a bucket of step 2's answers holds, about.
BUCKET_SETS = 20_000
#: Most entries of the table of frequent tokens.
FREQUENT = 1 << 19
#: Longs of 64 bits in a set's parity bitmap.
BITMAP = 8
ORDERS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B)
_SHARD_SALT = np.uint64(0xA54FF53A5F1D36F1)


def _digests(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Order-free digest of each text's set; empty sets get 0."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ _SHARD_SALT))])
    n = np.diff(first).astype(np.uint64)
    return np.where(n > 0, mix(sums[first[1:]] - sums[first[:-1]] + n), 0).astype(np.int64)


def shingle_table(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, digest`` for every row of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens, first = shingle_sets(words_of(batch.column("text")), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(_digests(tokens, first))],
                    ["doc_id", "n_shingles", "digest"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, n_shingles long, digest long"
    )


def _short(tokens: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each token and its code there; together an order-free name for it."""
    return ((tokens >> np.uint64(32)) % np.uint64(shards)).astype(np.int32), tokens.astype(np.uint32)


def _packed_tokens(docs: DataFrame, size: int, shards: int) -> DataFrame:
    """Per map slice and shard: token codes by document, each with its documents in the slice.

    Of the documents of a slice that share a token, the first sends it; what the others
    share is counted here and goes along as ``more``.
    """

    def pack(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
        tokens, counts, digest = (np.concatenate(x) for x in zip(*parts))
        owner = np.repeat(np.arange(len(digest), dtype=np.int32), counts)
        sole = np.zeros(len(digest), dtype=bool)
        sole[np.unique(digest, return_index=True)[1]] = True  # equal sets count once
        tokens, owner = tokens[sole[owner]], owner[sole[owner]]
        if not len(tokens):
            return None
        order = np.argsort(tokens, kind="stable")
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = tokens[order[1:]] != tokens[order[:-1]]
        lead = np.flatnonzero(fresh)
        held = np.diff(np.append(lead, len(order)))
        more = np.bincount(owner[order[~fresh]], minlength=len(digest))
        at = np.sort(order[lead])  # by document
        local = np.empty(len(tokens), dtype=np.uint16)
        local[order[lead]] = np.minimum(held, 65535)
        shard, code = _short(tokens[at], shards)
        by = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[by], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            mine = by[bounds[s] : bounds[s + 1]]
            if len(mine):
                who, n = np.unique(owner[at[mine]], return_counts=True)
                rows.append((s, digest[who], n.astype("<i4"), code[mine], local[at[mine]]))
        none = np.zeros(0, dtype="<u4")
        with_more = np.flatnonzero(more)
        start = int(np.bitwise_xor.reduce(digest)) % shards  # another one for each slice, so that shards share the load
        for s, low in enumerate(range(0, len(with_more), 4096)):
            who = with_more[low : low + 4096]
            rows.append(((start + s) % shards, digest[who], more[who].astype("<i4"), none, none))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32())]
            + [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[1:]],
            ["shard", "digests", "counts", "codes", "held"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, pending = [], 0
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens, first = shingle_sets(words_of(batch.column("text")), size)
                parts.append((tokens, np.diff(first), _digests(tokens, first)))
                pending += len(tokens)
                if pending >= SLICE_TOKENS:
                    if (made := pack(parts)) is not None:
                        yield made
                    parts, pending = [], 0
        if parts and (made := pack(parts)) is not None:
            yield made

    return docs.select("text").mapInArrow(
        scan, "shard int, digests binary, counts binary, codes binary, held binary"
    )


def _shared_counts(packed: DataFrame, frequent_from: int, buckets: int) -> DataFrame:
    """Tokens and shared tokens of sets, packed by shard and bucket, and frequent tokens.

    A shard says nothing of a set less than half of whose tokens there are shared, as is
    so for nearly all sets; :func:`similar_sets` then takes half of them as the most.
    Rows with a bucket hold one binary of sets, those without one frequent token.
    """

    def count(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blocks = [
            tuple(np.frombuffer(x, dtype=d) for x, d in zip(row, ("<i8", "<i4", "<u4", "<u2")))
            for row in zip(*(table.column(c).to_pylist() for c in ("digests", "counts", "codes", "held")))
        ]
        full = [b for b in blocks if len(b[2])]
        digests, shared = [b[0] for b in blocks if not len(b[2])], [b[1] for b in blocks if not len(b[2])]
        sizes = list(shared)
        frequent = held = np.zeros(0, dtype=np.int64)
        if full:
            codes, where = np.unique(np.concatenate([b[2] for b in full]), return_inverse=True)
            held = np.bincount(where, np.concatenate([b[3] for b in full]).astype(np.float64))
            several = held[where] > 1
            counts = np.concatenate([b[1] for b in full])
            first = np.concatenate([[0], np.cumsum(counts)])
            sums = np.concatenate([[0], np.cumsum(several)])
            digests.append(np.concatenate([b[0] for b in full]))
            sizes.append(counts)
            shared.append(sums[first[1:]] - sums[first[:-1]])
            often = np.flatnonzero(held >= frequent_from)
            frequent = (np.int64(shard) << 32) + codes[often].astype(np.int64)
            held = held[often].astype(np.int64)
        digests, shared, sizes = (np.concatenate(x) for x in (digests, shared, sizes))
        some = np.flatnonzero(2 * shared >= sizes)
        facts = np.stack([digests[some], shared[some], sizes[some]], axis=1).astype("<i8")
        bucket = facts[:, 0] % buckets
        used = np.unique(bucket)
        n = len(frequent)
        return pa.table({
            "bucket": pa.array([*used.tolist(), *[None] * n], pa.int64()),
            "sets": pa.array([*(facts[bucket == b].tobytes() for b in used), *[None] * n], pa.binary()),
            "token": pa.array([*[None] * len(used), *frequent.tolist()], pa.int64()),
            "held": pa.array([*[None] * len(used), *held.tolist()], pa.int64()),
        })

    return packed.groupBy("shard").applyInArrow(
        count, "bucket long, sets binary, token long, held long"
    )


def _unpacked(counted: DataFrame) -> DataFrame:
    """``digest, shared, of``: sums over the shards that spoke of the set."""

    def merge(table: pa.Table) -> pa.Table:
        facts = np.frombuffer(b"".join(table.column("sets").to_pylist()), dtype="<i8").reshape(-1, 3)
        digest, where = np.unique(facts[:, 0], return_inverse=True)
        sums = [np.bincount(where, facts[:, k]).astype(np.int64) for k in (1, 2)]
        return pa.table({"digest": digest, "shared": sums[0], "of": sums[1]})

    return counted.where("bucket is not null").groupBy("bucket").applyInArrow(
        merge, "digest long, shared long, of long"
    )


class _Orders:
    """Prefixes of sorted token sets under the global orders."""

    def __init__(self, names: np.ndarray, held: np.ndarray, shards: int, threshold: tuple[int, int]) -> None:
        order = np.argsort(names)
        self.names, self.shards, self.threshold = names[order], shards, threshold
        self.classes = np.log2(np.maximum(held[order], 1)).astype(np.uint8) + np.uint8(1)

    def classes_of(self, tokens: np.ndarray) -> np.ndarray:
        shard, code = _short(tokens, self.shards)
        name = (shard.astype(np.int64) << 32) + code.astype(np.int64)
        if not len(self.names):
            return np.zeros(len(tokens), dtype=np.uint8)
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        return np.where(self.names[at] == name, self.classes[at], 0).astype(np.uint8)

    def prefix(self, tokens: np.ndarray, which: int, classes: np.ndarray) -> np.ndarray:
        up, down = self.threshold
        n = len(tokens)
        length = n - -(-up * n // down) + 1
        rank = np.lexsort((mix(tokens ^ np.uint64(ORDERS[which])), classes))
        return tokens[rank[:length]]


def with_digest(docs: DataFrame, size: int = 5) -> DataFrame:
    """``digest, text`` of every row, once for the copies within a slice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                digest = _digests(*shingle_sets(words_of(batch.column("text")), size))
                some = pa.array(np.unique(digest, return_index=True)[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest).take(some), batch.column("text").take(some)], ["digest", "text"]
                )

    return docs.select("text").mapInArrow(scan, "digest long, text string")


def similar_sets(docs: DataFrame, threshold: tuple[int, int] = (4, 5), size: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``threshold`` is the least similarity as a fraction of whole numbers.  Runs several
    jobs when called; what passes between them is in the shared scratch folder.
    """
    spark = docs.sparkSession
    up, down = threshold
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = cut_lineage(shingle_table(docs, size), "sets")
    facts = table.agg(F.sum("n_shingles").alias("entries"), F.count("*").alias("rows")).first()
    entries, buckets = facts.entries or 0, facts.rows // BUCKET_SETS + 1
    shards = max(1, math.ceil(entries / SHARD_TOKENS))
    sets = table.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n")
    )
    counted = cut_lineage(
        _shared_counts(_packed_tokens(docs, size, shards), max(16, -(-entries // FREQUENT)), buckets), "shared"
    )
    often = counted.where("bucket is null").select("token", "held").toPandas()
    orders = _Orders(often["token"].to_numpy(np.int64), often["held"].to_numpy(np.int64), shards, threshold)
    open_sets = sets.join(_unpacked(counted), "digest").withColumn(
        "m", F.expr("shared + (n - of) div 2")  # the most it can share with others
    ).where(f"m * {down} >= n * {up}")

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens, first = shingle_sets(words_of(batch.column("text")), size)
                mine = _digests(tokens, first) == batch.column("digest").to_numpy()
                raw = [tokens[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                bits = [
                    np.packbits(np.bincount(tokens[a:b] % np.uint64(64 * BITMAP), minlength=64 * BITMAP) & 1)
                    for a, b in zip(first[:-1].tolist(), first[1:].tolist())
                ]
                bits = np.concatenate(bits).view(np.int64)
                at = pa.array(np.arange(0, len(bits) + 1, BITMAP, dtype=np.int32))
                made = pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("digest", "n", "m")]
                    + [pa.array(raw, pa.binary()), pa.ListArray.from_arrays(at, pa.array(bits))],
                    ["digest", "n", "m", "tokens", "bits"],
                )
                yield made.filter(pa.array(mine))

    named_sets = docs.join(open_sets, "doc_id").select("digest", "n", "m", "text")
    # sets that only rows without an id hold are met by their digest
    nameless = with_digest(docs.where("doc_id is null"), size).join(
        open_sets.where("doc_id is null").drop("doc_id"), "digest"
    ).dropDuplicates(["digest"]).select("digest", "n", "m", "text")
    formed = named_sets.unionByName(nameless).mapInArrow(
        form, "digest long, n long, m long, tokens binary, bits array<long>"
    )
    formed = cut_lineage(formed, "open-sets")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets_of = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("tokens").to_pylist()]
            cuts = [orders.prefix(t, 0, orders.classes_of(t)) for t in sets_of]
            which = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
            token = np.concatenate(cuts).astype(np.int64) if cuts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token)] + [batch.column(c).take(pa.array(which)) for c in ("digest", "n", "m")],
                ["token", "digest", "n", "m"],
            )

    postings = formed.select("digest", "n", "m", "tokens").mapInArrow(
        post, "token long, digest long, n long, m long"
    )
    groups = postings.groupBy("token").agg(
        F.count("*").alias("c"), F.max(F.struct(F.col("m") / F.col("n"), "n", "digest", "m")).alias("lead")
    ).where("c > 1")
    postings = cut_lineage(postings.join(groups, "token"), "postings")

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs that share a prefix under every further order and reach the threshold."""
        one = formed.select(F.col("digest").alias("a"), F.col("tokens").alias("left"))
        two = formed.select(F.col("digest").alias("b"), F.col("tokens").alias("right"))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("left"), batch.column("right")):
                    x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                    cx, cy = orders.classes_of(x), orders.classes_of(y)
                    keep.append(
                        all(
                            len(np.intersect1d(orders.prefix(x, k, cx), orders.prefix(y, k, cy)))
                            for k in range(1, len(ORDERS))
                        )
                        and (both := len(np.intersect1d(x, y, assume_unique=True))) * down
                        >= (len(x) + len(y) - both) * up
                    )
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        joined = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
        return cut_lineage(joined.mapInArrow(compare, "a long, b long"), "links")

    def feasible(x: str, y: str) -> str:
        """Sizes, and shared tokens, that leave the threshold within reach."""
        return (
            f"least({x}n, {y}n) * {down} >= greatest({x}n, {y}n) * {up} and "
            f"least({x}m, {y}m) * {up + down} >= ({x}n + {y}n) * {up}"
        )

    def pairs(frame: DataFrame, x: str, y: str) -> DataFrame:
        return frame.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    starred = postings.where("digest <> lead.digest and " + feasible("", "lead."))
    links = verify(pairs(starred, "digest", "lead.digest"))
    found = cut_lineage(components(links), "components")

    placed = postings.drop("lead").join(
        found.withColumnRenamed("node", "digest"), "digest", "left"
    ).withColumn("component", F.coalesce("component", "digest"))
    split = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("token")
    bitmap = formed.select("digest", *[F.col("bits")[i].alias(f"b{i}") for i in range(BITMAP)])
    left = cut_lineage(placed.join(split, "token", "left_semi").join(bitmap, "digest"), "left")
    x, y = left.alias("x"), left.alias("y")
    differ = " + ".join(f"bit_count(x.b{i} ^ y.b{i})" for i in range(BITMAP))
    rest = x.join(y, F.expr(
        "x.token = y.token and x.digest < y.digest and x.component <> y.component and "
        + feasible("x.", "y.")
        + f" and ({differ}) * {up + down} <= (x.n + y.n) * {down - up}"
    ))
    late = verify(pairs(rest, "x.digest", "y.digest"))
    if late.limit(1).count():
        found = cut_lineage(components(links.unionByName(late)), "components")

    named = sets.join(found.withColumnRenamed("node", "digest"), "digest").groupBy("component").agg(
        F.min("doc_id").alias("component_id")
    )
    labels = found.join(named, "component").select(F.col("node").alias("digest"), "component_id")
    every = sets.select("digest", "doc_id").join(labels, "digest", "left").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    linked = table.join(every, "digest", "left")
    return linked.select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
