"""Brute force for the conversation repair: damage, faults and cheapest edits over all prefixes."""

import hashlib
import re
import zlib

SPACE = "\x20\x09-\x0D"


def damage(rows):
    """(conv, turn, role, text) after damage, in order, by conversation; all conversations are kept."""
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def fault(role, text, seen):
    solid = re.sub(f"[{SPACE}]", "", text)
    if not solid:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "sound" if solid[-1] in ".!?" else "truncated"


def cheapest(rows):
    """(cost, audit, repaired) by the least (cost, audit) of every prefix and every state of the pattern."""
    best = {"": (0, "", [])}
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def offer(into, state, cost, audit, turns):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = (cost, audit, turns)

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                for initial in "ua":
                    if (state, initial) in legal:
                        name = "user" if initial == "u" else "assistant"
                        offer(table, legal[state, initial], cost + 3, audit + "I", [*turns, (name, "")])
        return table

    best = inserts(best)
    for role, text, what in rows:
        after = {}
        for state, (cost, audit, turns) in best.items():
            offer(after, state, cost + 4, audit + "D", turns)
            if what in ("blank", "duplicate"):
                continue
            more = 3 if what == "truncated" else 0
            if (state, role[:1]) in legal:
                offer(after, legal[state, role[:1]], cost + more, audit + "K", [*turns, (role, text)])
            for initial, name in (("u", "user"), ("a", "assistant")):
                if (state, initial) in legal:
                    offer(after, legal[state, initial], cost + more + 3, audit + "R", [*turns, (name, text)])
        best = inserts(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def report(rows):
    """All rows of the query as tuples."""
    out = set()
    for conv, held in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in held:
            faults.append(fault(role, text, seen))
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, left = cheapest([(r, t, f) for (_, r, t), f in zip(held, faults)])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        out.add((conv, gaps, *counts, illegal, cost, audit, sha))
    return out
