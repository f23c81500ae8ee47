"""Plain restatements of what the queries return, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def secrets(docs):
    out = []
    for doc_id, text in docs:
        spans = secret_spans(text or "")
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        out.append((doc_id, *(sum(k == i for _, k, _ in spans) for i in range(3)), sha(joined)))
    return out


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near(docs):
    """Rows of (doc_id, n_shingles, component_id); all pairs are compared."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [(d, s) for d, s in sets if s and d is not None]
    for i, (a, x) in enumerate(usable):
        for b, y in usable[:i]:
            if 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return [(d, len(s), None if d is None else root(d)) for d, s in sets]


def warc(pages):
    by = defaultdict(list)
    for page_id, html in pages:
        raw = (html or "").encode()
        by[hashlib.sha256(raw).hexdigest(), len(raw)].append(page_id)
    out = []
    for (digest, size), ids in by.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        for k, page_id in enumerate(ids):
            again = k > 0 and size >= 100
            out.append((page_id, size, digest, "revisit" if again else "response", ids[0] if again else None))
    return out


BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


def licenses(docs):
    out = []
    for doc_id, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        starts, labels = [], set()
        for phrase, label in BASE:
            p = phrase.split()
            own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            starts += own
            labels |= {label} if own else set()
        out.append((doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return out


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def urls(pages):
    out = []
    for page_id, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, None))
        out.append((page_id, host, path, best[1], best[2]))
    return out


def topk(vectors, k=10):
    good = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, seen = [], set()
    for q, x in good:
        if q % 100 or (q, tuple(x)) in seen:
            continue
        seen.add((q, tuple(x)))
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(y) == len(x))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def chat(rows):
    """rows of (conv_id, turn, role, text); without formatted_chars."""
    by = defaultdict(list)
    text = "</s>[INST] ok [/INST]"
    for c, turn, role, t in [*rows, (-7, 0, "user", text), (-7, 1, "assistant", text)]:
        by[c].append(((turn is not None, turn), (role is not None, role), (t is not None, t)))
    out = []
    for c, turns in by.items():
        turns = [(r[1] or "", t[1] or "") for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return out


def _field(value) -> str:
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def _levels(nodes: list[str], fanout: int = 8) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def _path(levels: list[list[str]], at: int, fanout: int = 8) -> list[tuple[str, str]]:
    out = []
    for row in levels[:-1]:
        start = at // fanout * fanout
        out.append(("".join(row[start:at]), "".join(row[at + 1 : start + fanout])))
        at //= fanout
    return out


def _fold(path, start: str) -> str:
    for before, after in path:
        start = sha(before + start + after)
    return start


def manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); the op11 result as tuples."""
    leaf = lambda r: sha("".join(_field(v) for v in r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, leaf(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, subroots = {}, []
    for g in order:
        members = sorted(groups[g], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        levels = _levels([h for _, h in members])
        trees[g] = (members, levels)
        subroots.append(levels[-1][0])
    top = _levels(subroots)
    out = []
    for gi, g in enumerate(order):
        members, levels = trees[g]
        above = _path(top, gi)
        for i, (r, h) in enumerate(members):
            path = _path(levels, i) + above
            text = r[4]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            t = leaf((*r[:4], text.translate(UPPER) if (changed and text is not None) else text))
            folded = _fold(path, t)
            out.append((r[0], h, levels[-1][0], top[-1][0], sha("".join(b + a for b, a in path)), folded, folded == top[-1][0]))
    return out


def _discounts(n):
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.0
    return [min(float(k), max(0.1, k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0)) for k in (1, 2, 3)]


def lm_scores(rows):
    """rows: (doc_id, text); op13 as (doc_id, held_out, n_tokens, n_known, train_tokens, base, score)."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    toks = lambda t: [w for w in WORD.findall((t or "").translate(UPPER))] + ["\n"]
    tri = defaultdict(int)
    for d, t in rows:
        if not held(d):
            p = ["\t", "\t", *toks(t)]
            for i in range(2, len(p)):
                tri[tuple(p[i - 2 : i + 1])] += 1
    bi = defaultdict(int)  # continuation: distinct u
    for u, v, w in tri:
        bi[(v, w)] += 1
    uni = defaultdict(int)
    for v, w in bi:
        uni[w] += 1
    raw = defaultdict(int)
    for (u, v, w), c in tri.items():
        raw[w] += c
    n, vocab = sum(raw.values()), len(raw)

    def counts_of(values):
        return [sum(1 for x in values if x == k) for k in range(1, 5)]

    d1, d2, d3 = _discounts(counts_of(uni.values())), _discounts(counts_of(bi.values())), _discounts(counts_of(tri.values()))

    def disc(d, c):
        return 0.0 if c == 0 else d[min(c, 3) - 1]

    def ctx(table, key_of):
        out = defaultdict(lambda: [0, 0, 0, 0])
        for k, c in table.items():
            s = out[key_of(k)]
            s[0] += c
            s[min(c, 3)] += 1
        return out

    ctx2, ctx3 = ctx(bi, lambda k: k[0]), ctx(tri, lambda k: k[:2])
    t1 = sum(uni.values())
    n1 = counts_of(uni.values())
    g1 = (d1[0] * n1[0] + d1[1] * n1[1] + d1[2] * sum(1 for x in uni.values() if x >= 3)) / t1 if t1 else 1.0

    def level(c, s, d, lower):
        if s[0] == 0:
            return lower
        return max(c - disc(d, c), 0) / s[0] + (d[0] * s[1] + d[1] * s[2] + d[2] * s[3]) / s[0] * lower

    out = []
    for d, t in rows:
        p = ["\t", "\t", *toks(t)]
        score = base = known = 0
        for i in range(2, len(p)):
            u, v, w = p[i - 2 : i + 1]
            p1 = (max(uni[w] - disc(d1, uni[w]), 0) / t1 + g1 / (vocab + 1)) if t1 else 1 / (vocab + 1)
            p2 = level(bi[(v, w)], ctx2[v], d2, p1)
            score += math.log10(level(tri[(u, v, w)], ctx3[(u, v)], d3, p2))
            base += math.log10((raw[w] + 1) / (n + vocab + 1))
            known += raw[w] > 0
        out.append((d, held(d), len(p) - 2, known, n, base, score))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs, queries, k=20):
    """docs: (doc_id, text), queries: (item_id, text); op12 as (item_id, rank, doc_id, score)."""
    toks = [TERM.findall((t or "").translate(UPPER)) for _, t in docs]
    n_docs, length = sum(1 for t in toks if t), sum(len(t) for t in toks)
    df = defaultdict(int)
    for t in toks:
        for w in set(t):
            df[w] += 1
    items = defaultdict(list)
    for item, text in set(queries):
        items[item] += TERM.findall((text or "").translate(UPPER))
    out = []
    for item, q in items.items():
        scored = []
        for (doc_id, _), t in zip(docs, toks):
            if not t:
                continue
            m = 75 + (25 * len(t) * n_docs) // length
            s = 0
            for w in q:
                if df[w]:
                    tf = t.count(w)
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id, s))
        scored.sort()
        out += [(item, r + 1, x[3], x[4]) for r, x in enumerate(scored[:k])]
    return out
