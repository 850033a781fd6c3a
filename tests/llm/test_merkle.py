import hashlib
import zlib

import pytest
from check_oracle import compare, connect

from grainframe.llm.merkle import merkle_manifest, verified_documents
from grainframe.llm.queries import ORACLES, QUERIES

NAME = "op12_merkle_manifest"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root and, for each leaf, its siblings by level as (left, right)."""
    if len(leaves) == 1:
        return leaves[0], [[]]
    runs = [leaves[i : i + 3] for i in range(0, len(leaves), 3)]
    root, above = tree([sha(*run) for run in runs])
    return root, [
        [("".join(run[:k]), "".join(run[k + 1 :])), *above[r]] for r, run in enumerate(runs) for k in range(len(run))
    ]


def brute(rows):
    """Rows of the query from (doc_id, source, lang, n_chars, text) tuples."""
    def leaf(row):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for row in rows:
        doc, text = row[0], row[4]
        cut = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None
        now = (*row[:4], text.replace("\n", "")) if cut else row
        groups.setdefault(row[1], []).append((doc, leaf(row), leaf(now)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found, trees = [], {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = tree([r[1] for r in groups[g]])
    if not names:
        return []
    root, upper = tree([trees[g][0] for g in names])
    for g, over in zip(names, upper):
        for (doc, first, now), steps in zip(groups[g], trees[g][1]):
            steps, folded = [*steps, *over], now
            for left, right in steps:
                folded = sha(left, folded, right)
            proof = sha(*(x for s in steps for x in s))
            found.append((doc, first, trees[g][0], root, proof, folded, folded == root))
    return sorted(found, key=str)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_sql_and_brute_force(spark, folder):
    found = QUERIES[NAME](spark, folder)
    assert compare(found, connect(folder), ORACLES[NAME]) is None
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert _found(found) == brute([tuple(r) for r in table.collect()])


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 9, 10, 28])
def test_odd_rows(spark, size):
    """Nulls in every column, a null group, ties, repeated rows, one to many groups, a very long text."""
    rows = [(None if i % 7 == 3 else i // 2, None if i % 5 == 4 else f"s{'é' * (i % 3)}", None, None, "a\nb" * i) for i in range(size)]
    rows += rows[:2] + [(90, "long", "en", 1, "word\n" * 300_000), (-4, "one", "en", 1, None)] * (size > 4)
    odd = [(*r, "x", "y", 3) for r in rows]
    docs = spark.createDataFrame(
        odd, "doc_id long, source string, lang string, n_chars long, text string, g string, steps string, root int"
    )
    assert _found(verified_documents(docs)) == brute(rows)


def test_manifest_of_other_columns(spark):
    rows = [(f"f{i % 2}", i, sha(str(i))) for i in range(8)]
    found = merkle_manifest(spark.createDataFrame(rows, "folder string, part int, sha string"), "folder", "part", "sha")
    assert found.columns == ["folder", "part", "sha", "subroot", "root", "steps"]
    root, _ = tree([tree([r[2] for r in rows if r[0] == f])[0] for f in ("f0", "f1")])
    assert {r.root for r in found.collect()} == {root} and found.count() == 8
