"""Plain answers to hold the operators against."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(i):
    return zlib.crc32(str(i).encode())


def words(t):
    return WORD.findall(t or "")


def repeats(seqs, k):
    """{(doc position): covered} of sequences in document order."""
    first, out = {}, []
    for d, s in enumerate(seqs):
        cov = [False] * len(s)
        for i in range(len(s) - k + 1):
            w = tuple(s[i : i + k])
            if w in first:
                cov[i : i + k] = [True] * k
            else:
                first[w] = (d, i)
        out.append(cov)
    return out


def passages(docs, k=20):
    seqs = [words(t) for _, t in docs]
    rows = {}
    for (i, _), s, c in zip(docs, seqs, repeats(seqs, k)):
        kept = " ".join(w for w, x in zip(s, c) if not x)
        rows[i] = (len(s), sum(c), hashlib.sha256(kept.encode()).hexdigest())
    return rows


def strings(docs, k=100):
    seqs = [(t or "").encode() for _, t in docs]
    rows = {}
    for (i, _), s, c in zip(docs, seqs, repeats(seqs, k)):
        runs = sum(1 for j, x in enumerate(c) if x and not (j and c[j - 1]))
        rows[i] = (len(s), sum(c), runs, hashlib.sha256(bytes(b for b, x in zip(s, c) if not x)).hexdigest())
    return rows


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = words(ascii_lower(t))
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), 42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def contamination(docs, items, n=13):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    grams = [(str(i), w) for i, t in items for w in [norm(t)] if w]
    out = {}
    for i, t in docs:
        w = norm(t)
        hit, names = [False] * len(w), set()
        for name, g in grams:
            m = min(n, len(g))
            wins = {tuple(g[k : k + m]) for k in range(len(g) - m + 1)}
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in wins:
                    hit[k : k + m] = [True] * m
                    names.add(name)
        h = sum(hit)
        out[i] = (len(w), h, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), h > 0 and 20 * h >= len(w))
    return out


def base_statistics(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = [False] * len(w)
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            rep[i : i + 3] = [True] * 3
    r = sum(rep)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, len(w) < 50 or 100 * r > 50 * len(w)


def corpus(seed=0, n=60):
    """Invented documents with copies, near copies, shared passages, periodic and empty texts."""
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 7))) for _ in range(300)]
    text = lambda m: " ".join(rng.choice(vocab, m))
    passage, out = text(60), []
    for i in range(n):
        kind = i % 10
        t = text(int(rng.integers(1, 150)))
        if kind == 1 and i > 10:
            t = out[i - 7][1]
        elif kind == 2 and i > 10:
            w = (out[i - 10][1] or "").split(" ")
            w[len(w) // 2 :] = ["new"] + w[len(w) // 2 :]
            t = " ".join(w)
        elif kind == 3:
            t = text(9) + " " + passage + "\n" + text(11)
        elif kind == 4:
            t = "ab " * int(rng.integers(1, 90))
        elif kind == 5:
            t = ["", None, " \n\t", "x"][i // 10 % 4]
        elif kind == 6:
            t = "A" * int(rng.integers(90, 400))
        out.append((i, t))
    return out
