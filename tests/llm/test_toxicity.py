import numpy as np
from pyspark.sql import functions as F

from grainframe.llm.labelled import fold_of
from grainframe.llm.toxicity import BINS, LIMIT, _LANGUAGES, _Scorer, _threshold, fit, labelled, score_toxicity, thresholds


def test_threshold_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(50):
        clean, toxic = (rng.integers(0, 3, 2 * LIMIT * BINS) * (rng.random(2 * LIMIT * BINS) < 0.002) for _ in range(2))
        cut = _threshold(clean, toxic)
        if not clean.sum() or not toxic.sum():
            assert cut == 0
            continue
        places = np.arange(2 * LIMIT * BINS) / BINS - LIMIT

        def wrong(c):
            return 2 * clean[places >= c - 1e-9].sum() / clean.sum() + toxic[places < c - 1e-9].sum() / toxic.sum()

        assert wrong(cut) <= min(wrong(c) for c in np.append(places, LIMIT)) + 1e-9


def test_thresholds_cover_all_labels_not_trained_on(spark, folder):
    """With a small sample nearly all labels only set thresholds; the counts they are taken from hold all of them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    network, trained = fit(labelled(docs, labels, "toxic", 12), 12)
    assert 0 < len(trained) <= 24
    cuts = thresholds(docs, labels, "toxic", _Scorer(network), trained)
    assert len(cuts) == len(_LANGUAGES) + 1
    rest = docs.join(labels.where(~F.col("doc_id").isin(trained)), "doc_id")
    scored = score_toxicity(rest.select("doc_id", "text"), labels, folds=10**6, held_out=-1, sample=12)
    assert scored.count() == rest.count()


def test_accuracy_by_language(spark):
    """At sf0.01 every language with enough held-out labels is told well."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = score_toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    shares = scored.groupBy("lang").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right"), F.count("*").alias("n"))
    assert all(r.right >= 0.9 for r in shares.collect() if r.n >= 10)


def test_odd_rows(spark, odd_docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    odd = odd_docs.withColumnsRenamed({"kept": "language", "score": "bin"}).withColumn("predicted", F.lit("old"))
    odd = odd.unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    found = score_toxicity(odd, labels).collect()
    assert len(found) == odd.count() and not any(r.held_out for r in found if r.doc_id is None)
    assert all(r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.predicted for r in score_toxicity(odd, labels.where("false")).collect()} == {0}
    assert fold_of(5) is not None
