"""Parts of benchmark items, verbatim and paraphrased, in texts that hold nothing else of them."""

import random

import pytest

from grainframe.llm.decontaminate import RUN, find_leaks, verbatim_run

SCHEMA = "doc_id long, text string, leaks string, item_id int"


@pytest.fixture(scope="module")
def planted(spark, folder):
    """Documents with a part of one item each, by kind, and clean ones."""
    rng = random.Random(9)
    items = [(r.item_id, r.text.split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    items = [(i, w) for i, w in items if len(w) >= 40]
    long = [(1000 + k, sum((items[(3 * k + j) % len(items)][1] for j in range(3)), [])) for k in range(5)]
    pool = [w for _, words in items for w in words]
    docs, wanted = [], {}

    def add(kind, item, middle):
        filler = [rng.choice(pool)[::-1] + rng.choice("xyz") for _ in range(160)]
        docs.append((len(docs), " ".join(filler[:80] + middle + filler[80:]), "old", 1))
        wanted[len(docs) - 1] = (kind, item)

    for item, words in [*items, *long]:
        for share in (0.3, 0.5, 0.75, 0.9):
            n = max(2 * RUN + 4, int(len(words) * share))
            start = rng.randrange(len(words) - n + 1)
            add(f"run{share}", item, words[start : start + n])
        edited = [w if k % 6 else w[::-1] + "q" for k, w in enumerate(words)]
        add("edited", item, edited)
        add("clean", None, [])
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in [*items, *long]], "item_id long, text string")
    return spark.createDataFrame(docs, SCHEMA), benchmark, wanted


def test_recall_of_parts_of_items(planted):
    docs, benchmark, wanted = planted
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in find_leaks(docs, benchmark).collect()}
    by_kind = {}
    for doc, (kind, item) in wanted.items():
        hit = found[doc] == set() if kind == "clean" else item in found[doc]
        by_kind.setdefault(kind, []).append(hit)
    shares = {kind: sum(hits) / len(hits) for kind, hits in by_kind.items()}
    assert shares["clean"] == 1 and all(share >= 0.9 for share in shares.values()), shares


def test_verbatim_run_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(30) for _ in range(rng.randrange(1, 40))]
        region = [rng.randrange(30) for _ in range(60)]
        at, n = rng.randrange(len(item)), rng.randrange(1, 30)
        region[20:20] = item[at : at + n]
        least = min(RUN, len(item))
        brute = max((k for k in range(least, len(region) + 1) for i in range(len(region) - k + 1)
                     if all(any(region[j : j + least] == item[m : m + least] for m in range(len(item) - least + 1))
                            for j in range(i, i + k - least + 1))), default=0)
        assert verbatim_run(item, region) == brute


def test_rows_without_an_id(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    text = benchmark.first().text
    docs = spark.createDataFrame([(None, text, "x", 1), (None, None, "x", 1), (1, text, "x", 1), (1, text, "x", 1)], SCHEMA)
    assert sorted(len(r.leaks) > 0 for r in find_leaks(docs, benchmark).collect()) == [False, True, True, True]
    assert {len(r.leaks) for r in find_leaks(docs, benchmark.limit(0)).collect()} == {0}
