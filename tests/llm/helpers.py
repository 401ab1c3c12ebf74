"""Brute-force versions of the operators, written independently of them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text[, source]) rows."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# ------------------------------------------------------------------ spans

def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def pii_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def secret_base(text):
    text, out = text or "", []
    key = "|".join(("password", "passwd", "secret", "token", "api_?key"))
    key = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", key)
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ["assign", "access", "hex"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ------------------------------------------------------------------ quality

def quality(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "base_failed": failed}


# ------------------------------------------------------------------ near copies

def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_components(rows):
    """doc_id -> (set size, smallest id reachable) by comparing all that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


# ------------------------------------------------------------------ mixing

def mix_targets(sizes):
    """source -> target by resharing the excess until none is above three times its size."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: float(3 * sizes[s]) if s in capped else weight[s] * rest / w for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


# ------------------------------------------------------------------ language model

def base_scores(rows):
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts, end = Counter(), object()
    for t in train:
        counts.update(words(t))
        counts[end] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words(t), end]
        out.append((i, len(tokens), sum(counts[x] > 0 for x in tokens), n,
                    sum(log10((counts[x] + 1) / (n + v + 1)) for x in tokens)))
    return out
