"""Packing of tokenised documents into fixed-length sequences, shortest pack first.

1. Every document becomes token ids plus an end id, cut at multiples of the capacity.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the input) is
   packed on the driver: lengths longest first, each onto the shortest pattern it fits,
   with pattern counts split and updated.
3. Pieces get their rank within their length and are joined back to the pattern slot
   that owns this rank.

Defined results: null text counts as empty (only the end id); repeated rows are packed
each; an empty table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from grainframe.session import cut_lineage

#: Words kept with their ids within a task; beyond it the memory is emptied.
REMEMBERED = 400_000
# Pre-tokens of the vocabulary for plain Latin words; other words go through the library whole.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PRE = re.compile(r" |'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+")
#: Stands between words while their ids are joined; no id has these bytes.
_BORDER = b"\xff\xff\xff\xff"
_CODECS: dict[str, Codec] = {}


class Codec:
    """Token ids of texts as little-endian 32-bit bytes.

    The vocabulary drops white space between words, so a text's ids are those of its
    words in turn; words and their parts are encoded once and remembered.  Parts of plain
    Latin words go straight to the merges, spelt as the pre-tokeniser spells their
    characters.  A text that spells a special token is encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        spell = self.model.pre_tokenizer.pre_tokenize_str
        plain = filter(_PLAIN.fullmatch, map(chr, range(256)))
        self.spelling = str.maketrans({c: spell(c)[0][0] for c in plain})
        self.forget()

    def forget(self) -> None:
        """Let go of all words, so that a reused Python worker holds none between tasks."""
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {" ": _BORDER}

    def _whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        plain = list(filter(_PLAIN.fullmatch, words))
        self.words.update((word, self._whole(word)) for word in words.difference(plain))
        if not plain:
            return
        cut = _PRE.findall(" ".join(plain).lower())
        new = list(set(cut).difference(self.parts))
        merge = self.model.model.tokenize
        for part, spelt in zip(new, " ".join(new).translate(self.spelling).split(" ")):
            ids = [token.id for token in merge(spelt)]
            self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
        codes = b"".join(map(self.parts.__getitem__, cut)).split(_BORDER)
        self.words.update(zip(plain, codes))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self.words = {"": b""}
        if len(self.parts) > REMEMBERED:
            self.parts = {" ": _BORDER}
        split = [
            None if any(s in t for s in self.special) else t.replace("\n", " ").split(" ")
            for t in texts
        ]
        new = set().union(*filter(None, split)).difference(self.words)
        if new:
            self._learn(new)
        return [
            self._whole(text) if words is None else b"".join(map(self.words.__getitem__, words))
            for text, words in zip(texts, split)
        ]


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, end = _codec(tokenizer), np.uint32(end_id).tobytes()
        try:
            yield from pieces(batches, codec, end)
        finally:
            codec.forget()

    def pieces(batches: Iterator[pa.RecordBatch], codec: Codec, end: bytes) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows: list[tuple] = []
                for doc, raw in zip(part.column("doc_id").to_pylist(), codec.encode(texts)):
                    raw += end
                    n = len(raw) // 4
                    for start in range(0, n, capacity):
                        piece = raw[4 * start : 4 * (start + capacity)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, piece))
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    flat = np.frombuffer(b"".join(columns[5]), dtype="<u4").astype(np.int32)
                    at = np.concatenate([[0], np.cumsum(columns[2])]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, schema + (", ids array<int>" if keep_ids else "")
    )


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how often each is used.

    Lengths go longest first; each is added to the pattern that is shortest so far and
    still has room, splitting the pattern's count where fewer are needed.
    """
    patterns: dict[int, dict[tuple[int, ...], int]] = {}
    totals: list[int] = []  # sorted
    import bisect

    def put(total: int, pattern: tuple[int, ...], count: int) -> None:
        if total not in patterns:
            patterns[total] = {}
            bisect.insort(totals, total)
        patterns[total][pattern] = patterns[total].get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not totals or totals[0] + length > capacity:
                put(length, (length,), left)
                break
            total = totals[0]
            pattern, count = patterns[total].popitem()
            used = min(left, count)
            if used < count:
                patterns[total][pattern] = count - used
            if not patterns[total]:
                del patterns[total]
                totals.pop(0)
            put(total + length, (*pattern, length), used)
            left -= used
    return [(p, c) for total in totals for p, c in patterns[total].items()]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Per slot, ordered by length and rank: first key, first sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return (table[:, 0] << 44) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, keep_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and gapless ``offset``.

    Runs two jobs when called: the tokenised pieces are written once to the shared
    scratch folder, and their histogram is fetched.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id, keep_ids)
    pieces = cut_lineage(pieces.withColumn("__part", F.spark_partition_id()), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    keys, ranks, sequences, offsets = _slots(shortest_pack_first(histogram, capacity))

    counts = pieces.groupBy("__part", "length").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "__part", "length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    local = Window.partitionBy("__part", "length").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("__rank", F.row_number().over(local) - 1)
        .join(before, ["__part", "length"])
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
    )
    names = [c for c in pieces.columns if c != "__part"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("__rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + rank, side="right") - 1
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, `offset` long"
    return ranked.select(*names, "__rank").mapInArrow(place, schema)
