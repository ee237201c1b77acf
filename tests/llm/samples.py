"""Small tables with the awkward cases of every operator, and brute-force forms to hold them against."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # columns whose names the operators use inside
        "fp long, terms string, doc long, row string, spans string, kept string, body string, id long, k long, component long, ids string, secret_spans string")


def rows_of(pairs):
    """(doc_id, text) pairs as rows of ``DOCS``."""
    return [(i, t, "en", "src0", len(t) if t is not None else None, 1, "a", 2, "b", "c", "d", "e", 3, 4, 5, "f", "g") for i, t in pairs]


def messy(seed=3, words=4000):
    """Null and empty texts, a null id, repeated rows, ties, copies, near copies, shared passages, a long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(300), prose(90)
    loud = "".join(c.upper() if c < "{" else c for c in base)  # ASCII letters only
    near = base.split(" ")
    near[5], near[200] = "changed", "words"
    pairs = [(1, None), (2, ""), (3, " \t\n "), (4, base), (5, loud), (5, loud), (6, " ".join(near)), (None, base), (7, base),
             (8, prose(40) + "\n" + passage + " " + prose(20)), (9, prose(70) + " " + passage), (10, passage), (11, prose(49)), (12, "one"), (13, "one"),
             (14, prose(words)), (15, "x " * 500), (16, "x " * 400), (17, "a  b c\x0bd\x1ce ½ﬁ 日本語 🙂 it's I'LL <|endoftext|>tail\r\n"), (18, "ünïcode" * 50)]
    return pairs


def fingerprint(text, size=4):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable, by plain union and find."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def bench_words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def contaminated(text, items, size=13):
    """(n_words, n_hit, n_items, items) of one text; an item without an id counts and has no name."""
    words, hit, found = bench_words(text), set(), set()
    for item, said in items:
        theirs = bench_words(said)
        n = min(size, len(theirs))
        windows = {tuple(theirs[i:i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    return len(words), len(hit), len(found), sorted(str(item) for item in found if item is not None)


def without_repeats(pairs, size=50):
    """doc_id -> (n_words, n_removed, kept) judged on the whole input."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in pairs if i is not None}
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][at:at + size]), i)
    out = {}
    for i, said in words.items():
        gone = set()
        for at in range(len(said) - size + 1):
            if first[tuple(said[at:at + size])] < i:
                gone.update(range(at, at + size))
        out[i] = (len(said), len(gone), " ".join(w for at, w in enumerate(said) if at not in gone))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, size=5):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return {tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()
