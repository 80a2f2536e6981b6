"""Brute-force versions of the text operators, over ``[(doc_id, text)]``."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import regex
from xxhash import xxh64_intdigest

LOWEST = -2 ** 63


def below(doc_id):
    """A null doc_id sorts below every integer."""
    return LOWEST if doc_id is None else doc_id


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


class Union:
    def __init__(self, n):
        self.root = list(range(n))

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        self.root[self.find(a)] = self.find(b)


def secrets(docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.I | re.A)
    out = []
    for doc_id, text in docs:
        text = text or ""
        kinds = [[(m.start(), k, m.end()) for m in p.finditer(text) if good(m)] for k, (p, good) in enumerate((
            (assign, lambda m: len(m.group(2)) >= 12), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
            (re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16)))]
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(sum(kinds, [])))
        out.append((doc_id, *map(len, kinds), sha(said)))
    return out


def majority(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)][:len(words)]
    return majority([xxh64_intdigest(p, 42) for p in parts])


def simhash(docs):
    prints = [fingerprint(t) for _, t in docs]
    groups = Union(len(docs))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                groups.join(i, j)
    members = {}
    for i, (d, _) in enumerate(docs):
        members.setdefault(groups.find(i), []).append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return [(d, f"{prints[i]:016x}", least[groups.find(i)]) for i, (d, _) in enumerate(docs)]


def exact(docs):
    groups = {}
    norm = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "") for _, t in docs]
    for (d, _), n in zip(docs, norm):
        groups.setdefault(n, []).append(d)
    out = []
    for (d, _), n in zip(docs, norm):
        keep = max((x for x in groups[n] if x is not None), default=None)
        out.append((d, keep, len(groups[n]), d == keep, sha(n)))
    return out


def cut(docs, width=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            w = b[i:i + width]
            first[w] = min(first.get(w, 2 ** 63), below(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < below(d):
                gone[i:i + width] = b"\1" * width
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines(docs):
    """``{doc_id: (lines, removed line numbers)}``."""
    at = {}
    for d, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            if n := regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip():
                at.setdefault(n, set()).add((below(d), k))
    names = list(at)
    prints = [majority([xxh64_intdigest(w.encode(), 42) for w in n.split(" ")]) for n in names]
    groups = Union(len(names))
    for i, a in enumerate(names):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                if edits(a, names[j]) <= 0.2 * max(len(a), len(names[j])) + 1e-9:
                    groups.join(i, j)
    members = {}
    for i, n in enumerate(names):
        members.setdefault(groups.find(i), set()).update(at[n])
    gone = {}
    for places in members.values():
        for d, k in places - {min(places)}:
            gone.setdefault(d, set()).add(k)
    return {d: (len((t or "").split("\n")), sorted(gone.get(below(d), ()))) for d, t in docs}


def variants(docs, least_chars=5, least_count=3):
    """``(word, form, root, n, n_near, form_n)`` from all words without each of their letters."""
    count = {}
    for d, t in docs:
        for m in re.finditer("[A-Za-z\u00C0-\u00FF]+", t or ""):
            word = re.sub("[A-Z]", lambda x: x.group().lower(), m.group())
            h = zlib.crc32(f"{'' if d is None else d}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            count[word] = count.get(word, 0) + 1
    words = {w: n for w, n in count.items() if len(w) >= least_chars and n >= least_count}
    lacking = {}                       # words by what is left of them without one letter, and its place
    for w in words:
        for i in range(len(w)):
            lacking.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (head, tail), ws in lacking.items():
        for w in ws:
            near[w] |= ws - {w}
            if head + tail in words:
                near[w].add(head + tail)
                near[head + tail].add(w)
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def clusters(rows, k=8, rounds=10):
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``; every distance is measured."""
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
               if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((sha(f"3:{'' if i is None else i}"), v) for i, v in vectors)[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in vectors:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c
                     for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in vectors]
    whole = sum(d for _, _, d in found)
    inertia = {c: sum(d for _, x, d in found if x == c) for _, c, _ in found}
    inertia, whole = {c: x if x < 2 ** 63 else None for c, x in inertia.items()}, whole if whole < 2 ** 63 else None
    found = [(i, c, d if d < 2 ** 63 else None) for i, c, d in found]
    return [(i, c, d, inertia[c], whole, sha(",".join(map(str, centroids[c])))) for i, c, d in found]
