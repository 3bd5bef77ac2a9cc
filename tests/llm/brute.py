r"""Plain one-document-at-a-time versions of the contracts, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def low(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def secrets(text):
    t = text or ""
    any_case = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    keys = "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + "|" + any_case("api") + "_?" + any_case("key")
    spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
        rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    n = Counter(s[3] for s in spans)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)))


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def pii(text):
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]
    spans = [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, t) if ok(m)]
    n = Counter(s[0] for s in spans)
    return n["email"], n["ip"], n["card"], n["phone"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed)


def fingerprint(text):
    w = WORD.findall(low(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


def near(docs, radius=2):
    fp = {d: fingerprint(t) for d, t in docs}
    ids = sorted(fp)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fp[a] ^ fp[b]).bit_count() <= radius]
    comp = components(ids, links)
    return {d: (f"{fp[d]:016x}", comp[d]) for d in ids}


def repeats(docs, length=100):
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def top(rows, k=5):
    out = []
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in vecs:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vecs if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return out


def base_lm(docs):
    toks = {d: [*WORD.findall(low(t or "")), None] for d, t in docs}
    held = {d: crc32(str(d).encode()) % 7 == 2 for d in toks}
    c = Counter(w for d, ws in toks.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for d, ws in toks.items()}


def _runs(nodes):
    return [nodes[i:i + 16] for i in range(0, len(nodes), 16)]


def _tree(leaves):
    """Levels of digests from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(r)) for r in _runs(levels[-1])])
    return levels


def _climb(levels, i, now):
    """(siblings on the way up from leaf i, the root that ``now`` folds to in its place)."""
    proof = []
    for level in levels[:-1]:
        run, at = _runs(level)[i // 16], i % 16
        proof += run[:at] + run[at + 1:]
        now = sha("".join(run[:at] + [now] + run[at + 1:]))
        i //= 16
    return proof, now


def merkle(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: _tree([leaf(r) for r in by[s]]) for s in sources}
    top = _tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            now = leaf((*r[:4], low(r[4])) if r[0] is not None and r[4] is not None and crc32(str(r[0]).encode()) % 5 == 0 else r)
            p1, now = _climb(trees[s], i, now)
            p2, now = _climb(top, k, now)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, sha("".join(p1 + p2)), now, now == root))
    return out


def negatives(rows):
    """Contract rows of (vec_id, vector, label), ids distinct."""
    ok = [(i, [math.floor(256 * x) for x in v], (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows
          if None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, v, l in ok:
        if a % 50:
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, m == l) for i, w, m in ok if i != a and len(w) == len(v))
        for p, i, _ in [x for x in s if x[2]][:5]:
            hard = [(n, j) for n, j, same in s if not same and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(a, i, k + 1, j, -p, -n) for k, (n, j) in enumerate(hard)]
    return out


def shingle_groups(docs, percent=80):
    """(doc_id, n_shingles, component_id) by comparing all pairs of distinct sets."""
    sets = []
    for d, t in docs:
        w = WORD.findall(low(t or ""))
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(map(tuple, [w])) if w else frozenset())
    kinds = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    links = []
    for i, a in enumerate(kinds):
        for j in range(i):
            b = kinds[j]
            if 100 * len(b) >= percent * len(a) and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    comp = components(range(len(kinds)), links)
    place = {s: comp[i] for i, s in enumerate(kinds)}
    least = {}
    for (d, _), s in zip(docs, sets):
        if s and d is not None:
            least[place[s]] = min(d, least.get(place[s], d))
    return [(d, len(s), least.get(place[s]) if s else d) for (d, _), s in zip(docs, sets)]
