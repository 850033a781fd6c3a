"""Quality rules by repetition coverage.

Each whole text is cut into words; rolling hashes of several n-gram lengths find the
n-grams that occur more than once in the text, and the share of the text's word
characters that lie inside such n-grams, or on repeated lines, decides.

Defined results: a null or empty text has no words and fails the base rule; repeated rows
are judged each by itself; extra columns pass through; columns of the result win over
equally named ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from grainframe.llm.words import slices, utf8, words_of

SYMBOLS = b"#*$%&|<>"
#: Largest share of word characters inside repeated n-grams, by n-gram length.  One
#: sentence that opens and closes a text of 60 words covers up to 0.26 and is no fault.
NGRAM_SHARE = {5: 0.32, 6: 0.31, 7: 0.30, 8: 0.29, 9: 0.28, 10: 0.27}
LINE_SHARE = 0.30
SYMBOL_RATIO = 0.30
MIN_WORDS = 50

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_ROLL = np.uint64(0xD6E8FEB86659FD93)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, dup_ngram_share double, base_failed boolean, kept boolean"
)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """For each key whether it occurs at least twice."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _covered(repeated: np.ndarray, size: int, n: int) -> np.ndarray:
    """Words inside any repeated window of ``size`` words."""
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[: n - size + 1] += repeated
    edge[size : n + 1] -= repeated
    return np.cumsum(edge[:-1]) > 0


def _exact_triples(ids: np.ndarray) -> np.ndarray:
    """A number per 3-word window, equal exactly for equal windows."""
    kinds = int(ids.max()) + 1
    pair = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1].astype(np.int64)
    return pair[:-1] * kinds + ids[2:]


def measure_text(codes: np.ndarray, chars: np.ndarray, lines: list[str]) -> dict:
    """Repetition measures of one text from word codes, word sizes and its lines."""
    n = len(codes)
    total = int(chars.sum())
    repeat_words, shares = 0, {size: 0.0 for size in NGRAM_SHARE}
    if n >= 3:
        ids = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        repeat_words = int(_covered(_repeated(_exact_triples(ids)), 3, n).sum())
    if repeat_words:  # a repeated longer window holds repeated 3-word windows
        rolling = codes.copy()
        for size in range(2, max(NGRAM_SHARE) + 1):
            if n < size:
                break
            rolling = rolling[:-1] * _ROLL + codes[size - 1 :]
            if size in NGRAM_SHARE:
                inside = _covered(_repeated(rolling), size, n)
                shares[size] = float(chars[inside].sum()) / total
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in lines:
        if line in seen:
            dup_lines += 1
            dup_chars += len("".join(line.split()))
        seen.add(line)
    return {
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "dup_line_share": dup_chars / total if total else 0.0,
        "dup_ngram_share": max(shares.values()),
        "over": any(shares[s] > limit for s, limit in NGRAM_SHARE.items()),
    }


def _judge(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            words = words_of(batch.column("text"), fold=False)
            data, at = utf8(batch.column("text"))
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            sizes = points[words.ends] - points[words.starts]
            symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
            found = []
            for i in range(batch.num_rows):
                low, high = words.first[i], words.first[i + 1]
                n = int(high - low)
                n_symbols = int(symbols[at[i + 1]] - symbols[at[i]])
                text = data[at[i] : at[i + 1]].tobytes()
                # bytes.split() cuts at the same six white-space bytes as the words
                lines = [x for x in text.split(b"\n") if x.split()]
                lines = [x.decode("utf-8") for x in lines] if len(set(lines)) < len(lines) else []
                row = measure_text(words.codes[low:high], sizes[low:high], lines)
                failed = n < MIN_WORDS or 100 * row["n_repeat_words"] > 50 * n
                bad = (
                    row.pop("over")
                    or row["dup_line_share"] > LINE_SHARE
                    or n_symbols > SYMBOL_RATIO * n
                )
                found.append(
                    row
                    | {
                        "n_words": n,
                        "word_chars": int(sizes[low:high].sum()),
                        "n_symbols": n_symbols,
                        "base_failed": bool(failed),
                        "kept": not (failed or bad),
                    }
                )
            made = {name: [x[name] for x in found] for name in found[0]}
            columns = [
                pa.array(made[f.name], f.type)
                if f.name in made
                else batch.column(f.name).cast(f.type)
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Adds the repetition measures and the verdict ``kept`` to every row of ``docs``.

    Works row by row without a shuffle; each text is judged whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    added = _parse_datatype_string("struct<" + MEASURES.replace(" long", ":bigint")
                                   .replace(" double", ":double").replace(" boolean", ":boolean") + ">")
    names = {f.name for f in added}
    schema = StructType([f for f in docs.schema if f.name not in names] + list(added))
    arrow = to_arrow_schema(schema)
    return docs.mapInArrow(lambda batches: _judge(batches, arrow), schema)
