"""Plain single-process versions of the operators, written apart from them."""

import hashlib
from collections import Counter, defaultdict


def components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_links(sets, num, den):
    """All pairs (i, j) of sets with den * |both| >= num * |either|."""
    posting, out = defaultdict(list), []
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in posting[x])
        out += [(j, i) for j, c in common.items() if den * c >= num * (len(s) + len(sets[j]) - c)]
        for x in s:
            posting[x].append(i)
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lower(text or "")).split(" ") if w]


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def op1(rows):
    """rows: (doc_id, text), ids distinct. {doc_id: (n_shingles, component_id)}"""
    rows = sorted(rows)
    sets = [shingles(t) for _, t in rows]
    comp = components(len(rows), near_links(sets, 75, 100))
    return {d: (len(s), rows[c][0]) for (d, _), s, c in zip(rows, sets, comp)}


def op9(rows, num=80, den=100):
    """rows: (doc_id, text). {doc_id: text without its repeated lines}"""
    at = [(d, k) for d, t in sorted(rows) for k, _ in enumerate((t or "").split("\n"))]
    plain = [lower(x).strip(" \t\n\r\v\f").encode() for _, t in sorted(rows) for x in (t or "").split("\n")]
    distinct = list(dict.fromkeys(x for x in plain if x))
    index = {x: i for i, x in enumerate(distinct)}
    sets = [{x[i : i + 8] for i in range(max(len(x) - 7, 1))} for x in (y.decode() for y in distinct)]
    comp = components(len(distinct), near_links(sets, num, den))
    seen, gone = set(), set()
    for place, x in zip(at, plain):
        if x:
            c = comp[index[x]]
            if c in seen:
                gone.add(place)
            seen.add(c)
    return {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) if t is not None else None for d, t in rows}


def op5(rows, width=50):
    """rows: (doc_id, text), ids distinct. {doc_id: (n_bytes, n_removed, n_spans, sha256)}"""
    first, out = {}, {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        mine = set()
        for i in range(len(b) - width + 1):
            w = b[i : i + width]
            if w in first:
                gone[i : i + width] = b"\1" * width
            mine.add(w)
        first.update(dict.fromkeys(mine))
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def op7(rows, items, width=10):
    def tokens(text):
        return [w for w in "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lower(text or "")).split(" ") if w]

    windows = defaultdict(set)
    for i, t in items:
        w = tokens(t)
        for k in range(max(len(w) - width + 1, 1) if w else 0):
            windows[tuple(w[k : k + width])].add(i)
    lengths = {len(w) for w in windows}
    out = {}
    for d, t in rows:
        w = tokens(t)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out
