"""Plain versions of the operators, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(UP, LOW)
KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def jaccard_components(rows, percent=80):
    """rows: (doc_id, text) -> [(doc_id, set size, component)]."""
    sets = [shingles(t) for _, t in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    comp = components(len(rows), links)
    least = {}
    for (d, _), c in zip(rows, comp, strict=True):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return [(d, len(s), least.get(c) if s else d) for (d, _), s, c in zip(rows, sets, comp, strict=True)]


def contamination(docs, items, window=10):
    """docs, items: (id, text) -> [(doc_id, n_words, n_hit, n_items, sha)]."""
    grams = {}
    for i, t in items:
        w = TERM.findall((t or "").translate(LOWER))
        for s in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[s:s + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        w = TERM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                got = grams.get(tuple(w[s:s + n]))
                if got:
                    hit.update(range(s, s + n))
                    ids |= got
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


def passage_pairs(docs, words=50):
    """Pairs of rows that share a run of ``words`` words, and per row the words in such runs."""
    first, pairs, cover = {}, set(), {}
    split = [WORD.findall((t or "").translate(LOWER)) for _, t in docs]
    for d, w in enumerate(split):
        for i in range(len(w) - words + 1):
            first.setdefault(tuple(w[i:i + words]), []).append((d, i))
    for places in first.values():
        if len({d for d, _ in places}) > 1:
            for d, i in places:
                cover.setdefault(d, set()).update(range(i, i + words))
                if places[0][0] != d:
                    pairs.add((places[0][0], d))
    return pairs, cover
