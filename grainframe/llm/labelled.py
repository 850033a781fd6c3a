"""What the text classifiers share: folds and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Labelled rows of each class that class counts are taken over.
COUNTED = 20_000


def fold_of(parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; null ids belong to no fold."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, sample: int, counted: int = COUNTED
) -> DataFrame:
    """``doc_id, text, label, fit`` of at most ``counted`` labels of each class.

    Labels are chosen by the hash of their ids before they meet the texts: what is
    broadcast has at most twice ``counted`` rows, and no text is shuffled for the join.
    ``fit`` marks the first ``sample`` labels of each class.
    """
    names = labels.select("doc_id", F.col(label).cast("int").alias("label"), F.xxhash64("doc_id").alias("__key"))
    lowest = [
        names.where(F.col("label") == value).orderBy("__key", "doc_id").limit(counted) for value in (0, 1)
    ]
    place = F.row_number().over(Window.partitionBy("label").orderBy("__key", "doc_id"))
    chosen = lowest[0].unionByName(lowest[1]).withColumn("fit", place <= sample).drop("__key")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def bounded_sample(rows: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows marked ``fit`` of each label, those whose texts hash lowest."""
    keyed = rows.where("fit").withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    parts = [
        keyed.where(F.col("label") == value).orderBy("__key", "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).drop("__key")
