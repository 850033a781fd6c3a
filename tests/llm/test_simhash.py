import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from grainframe.llm.queries import QUERIES
from grainframe.llm.simhash import fingerprints_of, near_links, ring_keys, ring_links, simhash_groups


def brute_print(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """(doc_id, fingerprint, component) by comparing every pair of fingerprints."""
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    every = np.array(prints, dtype=np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(every[:i] ^ every[i]) <= 4):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def _found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_fingerprints():
    texts = [None, "", " \t\n ", "a", "a B", "A B C", "a b c d", "x" * 1000 + " b c d e", "É é " * 300, "\x0bq\x0c w\te r",
             "one two three four five " * 400, "w" * 33 + " " + "v" * 31, "end of text"]
    assert fingerprints_of(pa.array(texts)).tolist() == [brute_print(t) for t in texts]
    assert fingerprints_of(pa.array([], pa.string())).tolist() == []


def test_every_near_pair_passes_a_chain():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    b = a.copy()
    for i in range(len(a)):
        for bit in rng.choice(64, i % 8, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    left, right, passed = ring_keys(a), ring_keys(b), np.zeros(len(a), dtype=bool)
    for c in range(left.shape[1]):
        same = np.flatnonzero(left[:, c] == right[:, c])
        passed[same] |= ring_links(a[same], b[same], (left[same, c] >> np.uint64(32)).astype(np.int64))
    assert (passed == (np.bitwise_count(a ^ b) <= 4)).all()


@pytest.mark.parametrize("limit", [1024, 60, 3])
def test_links_connect_as_all_pairs_do(spark, limit):
    """Crowded keys, by the whole list, by spanning links and by shared values."""
    from grainframe.llm.components import components

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**62, 6, dtype=np.int64)
    values = set(centres.tolist())
    for _ in range(400):
        value = int(centres[rng.integers(0, 6)])
        for bit in rng.choice(60, rng.integers(0, 5), replace=False):
            value ^= 1 << int(bit)
        values.add(value)
    values = sorted(values)
    found = {r.node: r.component for r in components(near_links(spark.createDataFrame([(v,) for v in values], "p long"), limit)).collect()}
    every, label = np.array(values), np.arange(len(values))
    for _ in range(len(values)):
        before = label.copy()
        for i in range(len(values)):
            near = np.bitwise_count((every ^ every[i]).view(np.uint64)) <= 4
            label[i] = label[near].min()
        if (label == before).all():
            break
    assert [found.get(v, v) for v in values] == every[label].tolist()


def test_groups(spark, folder, odd_docs, odd_rows, no_docs):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert _found(QUERIES["op13_simhash_dedup"](spark, folder)) == brute_groups(rows)
    nameless = [(None, odd_rows[0][1]), (None, "quite alone among all of these"), (None, None)]
    more = spark.createDataFrame(nameless, "doc_id long, text string")
    found = simhash_groups(odd_docs.withColumnsRenamed({"kept": "print", "score": "key"}).unionByName(more, allowMissingColumns=True))
    assert _found(found) == brute_groups(odd_rows + nameless)
    assert simhash_groups(no_docs).count() == 0
