"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


# --- secrets

ASSIGN = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?'
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base_spans(text):
    text = text or ""
    s = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
          if len(m[0]) >= 16]
    s += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    n = Counter(x[2] for x in s)
    return (n["assign"], n["access"], n["hex"],
            sha(",".join(f"{k}:{a}:{e}" for a, _, k, e in sorted(s))))


# --- mixing

def targets(sizes: dict):
    """{source: size} (None last) -> {source: target} by resharing excess."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    out, left, rest = {}, set(names), sum(sizes.values())
    while left:
        total = sum(weight[s] for s in left)
        full = [s for s in left if rest * weight[s] / total > 3 * sizes[s]]
        if not full:
            return out | {s: rest * weight[s] / total for s in left}
        for s in full:
            out[s] = 3 * sizes[s]
            rest -= out[s]
            left.remove(s)
    return out


# --- quality

def measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    c = Counter(at)
    cover = {j for i, g in enumerate(at) if c[g] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover))


# --- decontamination

BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text, bench):
    w = BENCH_WORD.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for item, t in bench:
        b = BENCH_WORD.findall((t or "").translate(LOWER))
        n = min(10, len(b))
        wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                items |= {str(item)} - {"None"}
    return (len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit))


# --- line deduplication

def dedup_lines(docs, min_words=50):
    """[(doc_id, text)] in order -> [(n_lines, n_deleted, text)]"""
    seen, out = set(), []
    for _, text in docs:
        lines = (text or "").split("\n")
        idx = [i for i, x in enumerate(lines) if WORD.search(x)]
        words = [len(WORD.findall(lines[i])) for i in idx]
        gone = set()
        for a in range(len(idx)):
            total, z = 0, a
            while z < len(idx) and total < min_words:
                total += words[z]
                z += 1
            if total < min_words:
                break
            run = tuple(lines[i] for i in idx[a:z])
            if run in seen:
                gone.update(idx[a:z])
            seen.add(run)
        out.append((len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def dedup_maximal_runs(docs, min_words=50):
    """As ``dedup_lines``, each run as long as it equals an earlier one."""
    seen, out = set(), []
    for _, text in docs:
        lines = (text or "").split("\n")
        idx = [i for i, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for a in range(len(idx)):
            runs = [tuple(lines[i] for i in idx[a:z]) for z in range(a + 1, len(idx) + 1)]
            for run in runs:
                if run in seen and sum(len(WORD.findall(x)) for x in run) >= min_words:
                    gone.update(idx[a:a + len(run)])
            seen.update(runs)
        out.append((len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


# --- Jaccard join

def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def components(docs):
    """[(doc_id, text)] -> [(n_shingles, component_id)]"""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


# --- periodic runs

def periodic_runs(w):
    """(start, length, period) of the runs of a list of words."""
    out = set()
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(24, 3 * q) and not any(
                    all(w[k] == w[k + p] for k in range(s, i + q - p)) for p in range(1, q)):
                out.add((s, i - s + q, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def planted(doc_id, w):
    import zlib
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs_row(doc_id, text, plant):
    w = WORD.findall(text or "")
    if plant:
        w = planted(doc_id, w)
    runs = periodic_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


# --- conversations

def trie(rows, shared=True):
    """Rows (conv_id, turn, role, text) -> node rows, sorted."""
    import zlib
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for s in members:
        if s:
            kids[s[:-1]] += 1
    for s, m in members.items():
        w = (len(m) - 1) * len(s[-1][1]) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += w
    return sorted(((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s],
                    saved[s], sha(",".join(str(c) for c in sorted(m) if seqs[c] == s)))
                   for s, m in members.items()), key=repr)
