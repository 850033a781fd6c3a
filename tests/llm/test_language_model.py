"""The trie's probabilities against a plain interpolated model of dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from grainframe.llm.elias_fano import select_bit
from grainframe.llm.language_model import DISCOUNT, score_texts

END = None


def _tokens(text):
    folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), END]


def plain_scores(rows, least):
    """log10 probability of every text, unquantised."""
    train = [_tokens(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(t, t[1:]))
    three = Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    kept2 = {p: n for p, n in two.items() if n >= least[2]}
    kept3 = {p: n for p, n in three.items() if n >= least[3]}
    total, below = sum(one.values()), 0.1 * (len(one) + 1)
    spent = Counter()
    for (a, _), n in kept2.items():
        spent[a] += (n - DISCOUNT) / one[a]
    for (a, b, _), n in kept3.items():
        spent[a, b] += (n - DISCOUNT) / two[a, b]

    def probability(before, word):
        p = (one[word] + 0.1) / (total + below)
        if before and before[-1] in one:
            a = before[-1]
            p = max(kept2.get((a, word), 0) - DISCOUNT, 0) / one[a] + (1 - spent[a]) * p
        if len(before) > 1 and tuple(before[-2:]) in kept2:
            a, b = before[-2:]
            p = max(kept3.get((a, b, word), 0) - DISCOUNT, 0) / two[a, b] + (1 - spent[a, b]) * p
        return p

    return [sum(math.log10(probability(t[max(0, k - 2) : k], w)) for k, w in enumerate(t)) for t in (_tokens(x) for _, x in rows)]


@pytest.mark.parametrize("least", [{2: 2, 3: 3}, {2: 1, 3: 1}])
def test_scores_equal_a_plain_model(spark, folder, least):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    rows += [(None, "a lone text without an id"), (None, None), (rows[0][0], rows[0][1])]
    docs = spark.createDataFrame([(*r, -1.0) for r in rows], "doc_id long, text string, base_score double")
    found = score_texts(docs, min_count=least).collect()
    expected = dict(zip(rows, plain_scores(rows, least)))
    assert len(found) == len(rows)
    for r in found:
        # a step of quantisation is 0.03 of a decade, so a token is off by half of it, here and there by a bit more
        assert abs(r.score - expected[r.doc_id, r.text]) <= 0.018 * r.n_tokens + 0.05
        assert r.base_score < 0 and r.n_known <= r.n_tokens
    off = sum(abs(r.score - expected[r.doc_id, r.text]) for r in found) / sum(r.n_tokens for r in found)
    assert off < 0.004


def test_select_bit():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    words[:4] = [2**64 - 1, 1, 2**63, 2**64 - 1]
    k = np.array([rng.integers(0, int(w).bit_count()) if w else 0 for w in words], dtype=np.uint64)
    k[0] = 63
    places = [[i for i in range(64) if int(w) >> i & 1][int(n)] for w, n in zip(words, k) if w]
    assert select_bit(words[words > 0], k[words > 0]).tolist() == places
