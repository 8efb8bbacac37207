"""Plain forms of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(documents, benchmark, window=10):
    """``documents`` and ``benchmark``: (id, text) rows."""
    owners = {}
    for item, text in benchmark:
        words = plain_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            owners.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in owners}
    out = []
    for doc, text in documents:
        words, hit, items = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = owners.get(tuple(words[i : i + size]))
                if own is not None:
                    hit.update(range(i, i + size))
                    items.update(str(x) for x in own if x is not None)
        out.append((doc, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(documents):
    sets = [(doc, shingles(text)) for doc, text in documents]
    holders = {}
    for i, (_, own) in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    links = []
    for i, j in pairs:
        a, b = sets[i][1], sets[j][1]
        if 100 * len(a & b) >= 75 * len(a | b):
            links.append((sets[i][0], sets[j][0]))
    roots = smallest_reachable([d for d, _ in sets], links)
    return [(doc, len(own), roots[doc], roots[doc] == doc) for doc, own in sets]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_data(text):
    """Counts by kind and the digest of the base spans."""
    spans, counts = [], []
    for rank, (kind, pattern) in enumerate(PERSONAL.items()):
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), rank, kind, m.end()))
            n += 1
        counts.append(n)
    written = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
    return (*counts, sha(written)), written


def chat(rows):
    """``rows``: (conv_id, turn, role, text)."""
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or "", r[3] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss)))
    return out


def check_packing(documents, pieces, encode, capacity=2048):
    """``pieces``: rows as dicts. Returns the number of padding tokens; raises on a fault."""
    import struct

    ids = {doc: [*encode(text or ""), 1] for doc, text in documents}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            cut = ids[doc][p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids[doc]) and p["length"] == len(cut) > 0
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))
            at += p["length"]
        assert at == len(ids[doc])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding
