"""Plain single-process versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def components(nodes, links):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def jaccard_components(rows):
    """doc_id -> (set size, component) over rows of (doc_id, text) with distinct ids."""
    sets = {d: shingles(t) for d, t in rows}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    common = {}
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    found = components(sets, links)
    return {d: (len(s), found[d]) for d, s in sets.items()}


def usable(vector):
    return vector is not None and len(vector) and all(x is not None and np.isfinite(x) for x in vector)


def top_k(rows, k=5):
    rows = sorted((i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if usable(v))
    out = []
    for q, v in rows:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def cosine_links(rows, least=0.9):
    ids = [i for i, _ in rows]
    good = [(i, np.array(v, float)) for i, v in rows if usable(v) and np.any(np.array(v, float))]
    links = [(a, b) for n, (a, v) in enumerate(good) for b, w in good[n + 1:]
             if len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= least]
    found = components(ids, links)
    return sorted((i, sum(i in x for x in links), found[i], found[i] == i) for i in ids)


def targets(sizes):
    """source -> target, from source -> size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        free = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return capped | {s: weight[s] * level for s in free}
        capped |= {s: 3.0 * sizes[s] for s in over}


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def pii(text):
    out = []
    for kind, pattern in PII:
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if "0" <= c <= "9"]
            good = True
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                doubled = [sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
                good = 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            elif kind == "phone":
                good = 8 <= len(digits) <= 15
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())
