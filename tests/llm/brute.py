"""Plain versions of what the operators have to return, one text at a time."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words(fold(text))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def similar(docs):
    """{doc_id: (set size, smallest id reachable)} of (doc_id, text) rows."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    shared = Counter()
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def personal(text):
    """Base spans as {kind: [(start, end)]}."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
               lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text) if ok(m)] for k, (p, ok) in rules.items()}


def base_digest(spans):
    text = ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)
    return hashlib.sha256(text.encode()).hexdigest()


def check_packing(docs, pieces, tokenizer, capacity=4096, end_id=2):
    """Assert that ``pieces`` (dicts) hold every id of every document once, gapless, within capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + p["length"]])
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += p["length"]
        assert at == len(ids)
    used = 0
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        used += at
    return used / (capacity * len(by_sequence))
