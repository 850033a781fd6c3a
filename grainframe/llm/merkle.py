"""Merkle manifests: a digest tree per group and one over the groups, with a proof for each row.

Every level is a sibling-shift self-join.  A node knows its index ``i``, so its place in
its run (``slot = i % ARITY``) and the indices of its siblings (``i - slot + other slot``)
are computed, and two equi joins on (group, index) bring their digests.  The rows of slot
zero then hold a whole run and emit the parent.  Keys are unique, so a group with a third
of all rows spreads like any other; a level holds a third of the nodes of the one below.

Proofs are handed down from the top: a node's steps are its own siblings followed by the
steps of its parent, so each level is joined once, with its parents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.operators.ordering import row_id
from grainframe.session import cut_lineage

#: Nodes of a run.  The shifts below are written for two siblings.
ARITY = 3
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 bytes of all parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value (integers decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf upwards, left to right."""
    return digest(F.array_join(F.transform(steps, lambda s: F.concat(s.left, s.right)), ""))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda h, s: digest(s.left, h, s.right))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with the joined digests of the siblings ``left`` and ``right`` of them."""
    slot = F.col("i") % ARITY
    shifted = nodes.withColumns(
        {f"j{k}": F.col("i") - slot + (slot + k) % ARITY for k in (1, 2)}
    )
    for k in (1, 2):
        other = nodes.select("g", F.col("i").alias(f"j{k}"), F.col("h").alias(f"h{k}"))
        shifted = shifted.join(other, ["g", f"j{k}"], "left")
    h1, h2 = F.coalesce("h1", F.lit("")), F.coalesce("h2", F.lit(""))
    return shifted.withColumns(
        {
            "left": F.when(slot == 0, "").when(slot == 1, h2).otherwise(F.concat(h1, h2)),
            "right": F.when(slot == 0, F.concat(h1, h2)).when(slot == 1, h1).otherwise(""),
        }
    ).drop("j1", "j2", "h1", "h2")


def _depth(most: int) -> int:
    levels = 0
    while most > 1:
        most, levels = -(-most // ARITY), levels + 1
    return levels


def _levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees at once, each written, and the roots ``(g, h, depth)``.

    ``nodes`` has ``g`` (tree), ``i`` (0-based index), ``n`` (nodes of the tree on this
    level) and ``h``; ``most`` is the greatest ``n``.
    """
    spread = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels, roots = [], nodes.where("n = 1").select("g", "h", F.lit(0).alias("depth"))
    for level in range(_depth(most)):
        # a third of the nodes below, so a third of their tasks and files
        joined = _with_siblings(nodes.where("n > 1")).coalesce(max(1, spread // ARITY**level))
        held = cut_lineage(joined, f"merkle{level}")
        levels.append(held)
        nodes = held.where(F.col("i") % ARITY == 0).select(
            "g",
            F.expr(f"i div {ARITY}").alias("i"),
            F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
            digest(F.col("h"), F.col("right")).alias("h"),
        )
        roots = roots.unionByName(nodes.where("n = 1").select("g", "h", F.lit(level + 1).alias("depth")))
    return levels, roots


def _handed_down(levels: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Steps of every node of level 0; ``tops`` has ``g, depth, steps`` and the ``carried`` columns."""
    above = tops.where(F.col("depth") == len(levels)).select("g", F.lit(0).cast("long").alias("i"), "steps", *carried)
    for level in reversed(range(len(levels))):
        nodes = levels[level].withColumn("p", F.expr(f"i div {ARITY}"))
        parent = above.withColumnRenamed("i", "p").withColumnRenamed("steps", "more")
        kept = [] if level else [c for c in levels[0].columns if c not in {"g", "i", "n", "left", "right"}]
        here = nodes.join(parent, ["g", "p"]).select(
            "g",
            "i",
            F.concat(F.array(F.struct("left", "right")), F.col("more")).alias("steps"),
            *carried,
            *kept,
        )
        if level:
            alone = tops.where(F.col("depth") == level)
            here = here.unionByName(alone.select("g", F.lit(0).cast("long").alias("i"), "steps", *carried))
        above = here
    return above


def merkle_manifest(rows: DataFrame, group: str, order: str, leaf: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per row: ``group, order, leaf, *keep, subroot, root, steps``.

    Leaves of a group ascend by ``order`` (nulls first), then by ``leaf`` and ``keep``.
    While a tree has several nodes, every three consecutive ones become the digest of
    their digests (the last run may hold fewer, even one).  What remains is the group's
    ``subroot``, for a single row its leaf.  The subroots, by group (null first, then
    bytewise), give ``root`` in the same way.  ``steps`` lists a row's siblings per level
    from leaf to root; :func:`fold` and :func:`proof_digest` use it.

    Null groups form a group of their own, null order values are leaves like others,
    repeated rows are leaves each, an empty table gives no rows, and columns not named
    are left out, whatever their names.  Rows are read by digest only: texts of any
    length count once, in the scan that makes the leaf.  Jobs run when called.
    """
    named = rows.select(
        F.col(group).alias("k"), F.col(order).alias("o"), F.col(leaf).alias("h"),
        *[F.col(c).alias(f"v{j}") for j, c in enumerate(keep)],
    ).withColumns({"k0": F.col("k").isNotNull(), "o0": F.col("o").isNotNull()})
    values = [f"v{j}" for j in range(len(keep))]
    # written, as numbering reads the rows twice: texts are digested once
    named = cut_lineage(named, "merkle-leaves")
    placed = row_id(named, [(c, "asc") for c in ("k0", "k", "o0", "o")], "at", ["h", *values])
    groups = placed.groupBy("k").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = row_id(groups.withColumn("k0", F.col("k").isNotNull()), [("k0", "asc"), ("k", "asc")], "g")
    groups = cut_lineage(groups.select("k", "first", "n", F.col("g") - 1), "merkle-groups").toDF("k", "first", "n", "g")

    nodes = placed.join(groups, placed.k.eqNullSafe(groups.k)).select(
        "g", (F.col("at") - F.col("first")).alias("i"), "n", "h", placed.k, "o", *values
    )
    facts = groups.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    levels, subroots = _levels(nodes, facts.most or 0)
    subroots = cut_lineage(subroots, "merkle-subroots")

    over = subroots.select(
        F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(facts.groups).cast("long").alias("n"), "h"
    )
    upper, root = _levels(over, facts.groups)
    root = root.select("g", "depth", F.col("h").alias("root"), F.array().cast(STEP).alias("steps"))
    if upper:
        tops = _handed_down(upper, root, ["root"]).select(F.col("i").alias("g"), "root", "steps")
    else:
        tops = root.select("g", "root", "steps")
    tops = cut_lineage(
        subroots.withColumnRenamed("h", "subroot").join(tops, "g").select("g", "depth", "steps", "subroot", "root"),
        "merkle-tops",
    )
    single = nodes.where("n = 1").join(tops.drop("depth"), "g")
    columns = [
        F.col("k").alias(group), F.col("o").alias(order), F.col("h").alias(leaf),
        *[F.col(v).alias(c) for v, c in zip(values, keep)], "subroot", "root", "steps",
    ]
    found = single.select(*columns)
    if levels:
        found = _handed_down(levels, tops, ["subroot", "root"]).select(*columns).unionByName(found)
    return found


def document_leaf(text: Column) -> Column:
    """Leaf of a row of ``documents``, with ``text`` in place of its text."""
    return digest(*[framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], framed(text))


def verified_documents(docs: DataFrame) -> DataFrame:
    """Manifest of ``documents`` and a check of every row against a tampered copy.

    Where 2 divides the CRC-32 of the decimal ``doc_id``, the copy's text lost its line
    feeds.  Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    A null text stays null; a row without an id is not tampered with.
    """
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(lost, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = docs.select(
        "doc_id", "source", document_leaf(F.col("text")).alias("leaf"), document_leaf(now).alias("now")
    )
    found = merkle_manifest(rows, "source", "doc_id", "leaf", ["now"])
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        fold(F.col("now"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
