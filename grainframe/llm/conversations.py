"""Repair of the turn structure of conversations by the cheapest edits.

Edits keep a row (K, free), re-role it to user or assistant (R, 3), delete it (D, 4) or
insert an empty turn (I, 3); a truncated row that stays costs 3 more, blank and repeated
rows have to go.  The role initials left over must read ``(s?(ua)+)?``.

The search is iterative-deepening A*: depth first in ASCII order of the edits under an
increasing bound, with what is still certain to be paid as the estimate and a table of
failed states, which holds for each the cost known not to suffice.  The first accepting
path is the cheapest, and among these the ASCII-least.

A conversation is searched in blocks of ``BLOCK`` rows from its last to its first.  The
goal states of a block carry the cost of all that follows, so the bound of each search
stays small and time grows with the number of rows.  Inserts belong to the row after
them; hence no block path is a prefix of another and taking the least path block by block
gives the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.session import cut_lineage

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
#: Rows searched at once.
BLOCK = 16
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"

# What has been put out so far: nothing, a system turn, ... up to a user's, up to an assistant's turn.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_NONE, "s"): _SYSTEM, (_USER, "a"): _ASSISTANT} | {(x, "u"): _USER for x in (_NONE, _SYSTEM, _ASSISTANT)}
_TURN = (_USER, _USER, _ASSISTANT, _USER)
_FAR = 1 << 60


def code_of(initial: str, fault: int) -> int:
    """A row as one byte: its role's initial (3 for any other than s, u, a) and its fault."""
    return (INITIALS.find(initial) % 4 if initial else 3) * 4 + fault


def _search(codes: bytes, start: int, rest: tuple[int, ...] | None) -> tuple[int, str, int]:
    """Cost, edits and end state of the first accepting path from ``start`` over ``codes``.

    ``rest`` is the cost of what follows by state; without it the conversation ends here.
    """
    size = len(codes)
    sure = [0] * (size + 1)
    for i in reversed(range(size)):
        sure[i] = sure[i + 1] + (0, COST[DELETE], COST[DELETE], TRUNCATED_COST)[codes[i] % 4]
    if rest is not None:
        sure = [s + min(rest) for s in sure]
    failed: dict[tuple[int, int], int] = {}
    path, end = [], start

    def descend(i: int, state: int, left: int) -> int:
        """-1 if ``left`` suffices from here, else a cost that is needed at least."""
        nonlocal end
        need = failed.get((i, state), sure[i])
        if need > left:
            return need
        if i == size:
            if rest is not None:
                if rest[state] <= left:
                    end = state
                    return -1
                return rest[state]
            if state in (_NONE, _ASSISTANT):
                end = state
                return -1
        needed = _FAR
        for edit, cost, at, then in moves(i, state):
            need = descend(at, then, left - cost)
            if need < 0:
                path.append(edit)
                return -1
            needed = min(needed, cost + need)
        failed[i, state] = max(needed, failed.get((i, state), 0))
        return failed[i, state]

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order with cost, next row and next state."""
        if i == size:
            if rest is None:
                yield INSERT, COST[INSERT], i, _TURN[state]
            return
        initial, fault = INITIALS[codes[i] // 4 : codes[i] // 4 + 1], codes[i] % 4
        yield DELETE, COST[DELETE], i + 1, state
        yield INSERT, COST[INSERT], i, _TURN[state]
        if fault in (BLANK, DUPLICATE):
            return
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if (state, initial) in _NEXT:
            yield KEEP, COST[KEEP] + more, i + 1, _NEXT[state, initial]
        yield REROLE, COST[REROLE] + more, i + 1, _TURN[state]

    bound = sure[0]
    while (need := descend(0, start, bound)) >= 0:
        bound = need
    return bound, "".join(reversed(path)), end


_searched = lru_cache(maxsize=100_000)(_search)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and ASCII-least cheapest edits of a conversation given as :func:`code_of` bytes."""
    blocks = [codes[at : at + BLOCK] for at in range(0, len(codes), BLOCK)] or [b""]
    found, rest = [], None
    for n, block in reversed(list(enumerate(blocks))):
        answers = {s: _searched(block, s, rest) for s in ((_NONE,) if n == 0 else range(4))}
        found.append({s: (edits, end) for s, (_, edits, end) in answers.items()})
        rest = tuple(cost for cost, _, _ in answers.values())
    audit, state = [], _NONE
    for answers in reversed(found):
        edits, state = answers[state]
        audit.append(edits)
    return rest[0], "".join(audit)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage that the CRC-32 of ``conv_id:turn`` names.

    Modulo 20: 0 drops the row (``copies`` 0, so that its conversation stays known), 1
    empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes it the user's.  Nulls in
    the key, in role and in text count as one space.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = spaced("text")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation together and in order: by turn (nulls first), role and digest of the text."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "sha")


def _stream(batches: Iterator[pa.RecordBatch], work: Callable, fields: list[tuple[str, pa.DataType]]):
    """What ``work`` makes of the rows of all batches, in batches of ``conv_id`` and ``fields``."""
    first = next(batches, None)
    if first is not None:
        schema = pa.schema([("conv_id", first.schema.field(0).type), *fields])
        rows = (row for batch in chain([first], batches) for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from _batched(work(rows), schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``limit`` bytes of text each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str | bytes))
        if size > limit:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audited(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, group in groupby(rows, itemgetter(0)):
        codes, turns, last = bytearray(), [], None
        count, illegal, before = [0] * 4, 0, None
        for _, turn, initial, fault, copies in group:
            again = fault if fault == BLANK else DUPLICATE
            codes.append(code_of(initial, fault)) if copies else None
            codes.extend(bytes([code_of(initial, again)]) * (copies - 1))
            if not copies:
                continue
            count[fault] += 1
            count[again] += copies - 1
            illegal += before is not None and before + initial not in LEGAL
            illegal += (copies - 1) * (initial + initial not in LEGAL)
            before = initial
            if turn is not None:
                turns = [turn, turn, 1] if not turns else [turns[0], turn, turns[2] + (turn != turns[1])]
        cost, audit = cheapest_edits(bytes(codes))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        yield conv, gaps, count[BLANK], count[DUPLICATE], count[TRUNCATED], illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` per conversation of :func:`damaged` rows.

    A row's first fault counts: blank, duplicate (its role and text stood earlier),
    truncated (its last character that is no white space is none of ``.!?``).  Rows of
    one turn are ordered by role and digest of the text.  A role without one of the
    initials s, u, a, an empty one too, cannot be kept.

    Texts are only met as digests.  Equal rows are counted before they are shuffled and
    the first of equal texts is found by an aggregate, so neither copies nor a very long
    conversation gather before the search, which streams them and holds one byte a row
    (as does the audit, one cell, itself).
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    ends = F.substring(bare, -1, 1)
    kind = F.when(bare == "", BLANK).when(~ends.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    there = F.col("copies") > 0
    facts = rows.select(
        "conv_id",
        "turn",
        F.when(there, F.col("role")).otherwise("").alias("role"),
        F.unhex(F.sha2(F.when(there, F.col("text")).otherwise(""), 256)).alias("sha"),
        kind.alias("kind"),
        "copies",
    ).groupBy("conv_id", "turn", "role", "sha").agg(F.first("kind").alias("kind"), F.sum("copies").alias("copies"))
    at = F.struct(F.col("turn").isNotNull(), "turn")
    first = facts.where(there).groupBy("conv_id", "role", "sha").agg(F.min(at).alias("first")).toDF("c", "r", "s", "first")
    met = facts.join(
        first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")), "left"
    )
    fault = F.when(F.col("kind") == BLANK, BLANK).when(~at.eqNullSafe(F.col("first")), DUPLICATE).otherwise(F.col("kind"))
    ordered = _ordered(met.withColumn("fault", fault)).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "copies"
    )
    fields = [*((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())]
    return ordered.mapInArrow(
        lambda batches: _stream(batches, _audited, fields),
        f"conv_id {_id_type(rows)}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string",
    )


def _id_type(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, group in groupby(rows, itemgetter(0)):
        audit = next(group)[1]
        left, place = len(audit) - audit.count(DELETE), 0
        for edit in audit:
            _, _, role, text = (conv, None, None, "") if edit == INSERT else next(group)
            if edit != DELETE:
                # an odd number of turns starts with a system turn, so users stand at its odd places
                turn = ("user", "assistant")[(place + left) % 2]
                yield conv, place, edit, role if edit == KEEP else turn, text
                place += 1


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of all turns left, each conversation in order in one partition.

    ``audited`` is :func:`audits` of the same rows.  Rows are streamed, one batch at a time.
    """
    kept = rows.where("copies > 0").select(
        "conv_id", "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("sha"),
        F.lit(None).cast("string").alias("audit"), F.explode(F.sequence(F.lit(1), "copies")),
    ).drop("col")
    heads = audited.select("conv_id", "audit")
    ordered = _ordered(kept.unionByName(heads, allowMissingColumns=True), F.col("audit").isNull())
    fields = [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(
        lambda batches: _stream(batches, _repaired, fields),
        f"conv_id {_id_type(rows)}, place long, edit string, role string, text string",
    )


def _digested(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, group in groupby(rows, itemgetter(0)):
        state = hashlib.sha256()
        for _, place, role, text in group:
            state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield conv, state.hexdigest()


def repair_report(rows: DataFrame) -> DataFrame:
    """:func:`audits` of :func:`damaged` rows with ``repaired_sha256``, the digest of the repaired conversation.

    The digest is taken over the newline-joined ``role:text`` of the turns left; its state
    is carried from row to row, so a conversation of any length is read once, in order, by
    one task that holds one batch.

    Each ``conv_id`` of the input has one row, null too (all rows without an id are one
    conversation); one without rows after the damage has zeros, an empty audit and the
    digest of nothing.  Null turns come first and do not count for ``gaps``.  Repeated
    rows are rows each, and duplicates of each other.  Columns not named are left out.
    An empty table gives no rows.  Jobs run when called.
    """
    audited = cut_lineage(audits(rows), "conversation-audits")
    digests = repaired_turns(rows, audited).select("conv_id", "place", "role", "text").mapInArrow(
        lambda batches: _stream(batches, _digested, [("sha", pa.string())]), f"conv_id {_id_type(rows)}, sha string"
    ).toDF("c", "sha")
    return audited.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        *audited.columns, F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
