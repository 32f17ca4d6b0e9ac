"""Plain single-process versions of the operators, for small tables."""

import re
import zlib
from collections import Counter

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def earlier_bytes(docs, window):
    """{id: (bytes, removed, runs, kept)} of (id, text) rows with distinct ids."""
    seen, out = set(), {}
    for d, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - window + 1):
            w = b[i:i + window]
            if w in seen:
                covered[i:i + window] = b"\1" * window
            seen.add(w)
        runs = sum(covered[i] and not (i and covered[i - 1]) for i in range(len(b)))
        out[d] = (len(b), sum(covered), runs, bytes(x for x, c in zip(b, covered) if not c))
    return out


def repeated_words(docs, window):
    """{id: (words, removed, kept)} of (id, text) rows with distinct ids."""
    texts = {d: words(t) for d, t in docs}
    n = Counter(tuple(w[i:i + window]) for w in texts.values()
                for i in range(len(w) - window + 1))
    out = {}
    for d, w in texts.items():
        covered = [False] * len(w)
        for i in range(len(w) - window + 1):
            if n[tuple(w[i:i + window])] > 1:
                covered[i:i + window] = [True] * window
        out[d] = (len(w), sum(covered), " ".join(x for x, c in zip(w, covered) if not c))
    return out


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text):
    import xxhash

    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, linked):
    """{id: least id of its group} of {id: value}."""
    u, ids = Union(values), sorted(values)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if linked(values[a], values[b]):
                u.join(a, b)
    return {d: u.find(d) for d in ids}


def cosine_links(vectors, least):
    """{id: (links, least id of its group)}; vectors that can't link are None."""
    u, n, ids = Union(vectors), dict.fromkeys(vectors, 0), sorted(vectors)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = vectors[a], vectors[b]
            if x is None or y is None or len(x) != len(y):
                continue
            if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                n[a] += 1
                n[b] += 1
                u.join(a, b)
    return {d: (n[d], u.find(d)) for d in ids}


def quality(text):
    """(words, word characters, symbols, duplicate lines, repeated words)."""
    text = text or ""
    w = words(text)
    n = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if n[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*"""
                          r"""["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets(text):
    """Base spans 'kind:start:end' by start, then kind."""
    found = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}")
             for i, (kind, (p, group, least)) in enumerate(BASE.items())
             for m in p.finditer(text or "") if len(m[group]) >= least]
    return [x for _, _, x in sorted(found)]


def best_fit(lengths, capacity):
    """Remaining capacities of the bins, sorted."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


def held_out(id):
    return id is not None and zlib.crc32(str(id).encode()) % 3 == 1


def aligned(texts, of_a, of_b, encode_a, encode_b):
    """Figures of each text by walking its bytes; ``of_`` gives an id's bytes."""
    import hashlib

    rows, links = [], []
    for text in texts:
        raw, sides = (" " + (text or "")).encode(), []
        for of, ids in ((of_a, encode_a(" " + (text or ""))), (of_b, encode_b(text or ""))):
            sides.append([(i, k) for k, i in enumerate(ids) for _ in of[i]])
            if not text or b"".join(of[i] for i in ids) != raw:
                sides[-1] = None
        if None in sides:
            rows.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        a, b = sides
        found = list(dict.fromkeys(zip(a, b)))
        links.append(Counter((x[0], y[0]) for x, y in found))
        groups, open_a, open_b = [], [], []
        for i, (x, y) in enumerate(zip(a, b)):
            end_a, end_b = a[i + 1:i + 2] != [x], b[i + 1:i + 2] != [y]
            open_a += [x[0]] * end_a
            open_b += [y[0]] * end_b
            if end_a and end_b:
                groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
                open_a, open_b = [], []
        rows.append((len(set(a)), len(set(b)), len(groups),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    total = sum(links, Counter())
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    return [(*r[:3], sum(l.values()), sum(n for p, n in l.items() if total[p] == best[p[1]]),
             sum(n * total[p] for p, n in l.items()), r[3]) for r, l in zip(rows, links)]


RUNS = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def spelling_words(docs):
    """{word: n} of (id, text) rows."""
    n = Counter()
    for d, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def spelling_forms(n):
    """{word: (n, n_near, form, form_n, root)} by comparing words that agree without a letter."""
    without = {}
    for w in n:
        for key in {(w[:i], w[i + 1:]) for i in range(len(w))}:
            without.setdefault(key, set()).add(w)
    whole = {}
    for (a, b), ws in without.items():
        whole.setdefault(a + b, set()).update(ws)
    near = {w: set() for w in n}
    for ws in without.values():  # one letter replaced
        for w in ws:
            near[w] |= ws - {w}
    for shorter, ws in whole.items():  # one letter more
        if shorter in n:
            for w in ws:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, ws in near.items():
        if ws:
            best = min(ws, key=lambda v: (-n[v], v))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root)
    return out
