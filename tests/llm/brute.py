"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def quality(docs):
    out = {}
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        n = len(words)
        out[doc_id] = (
            n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n,
        )
    return out


def line_dedup(docs):
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= 10:
                holders[key].add(doc_id)
    out = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(key := lower(x.strip(BLANKS))) < 10 or len(holders[key]) < 2 or min(holders[key]) == doc_id
        ]
        out[doc_id] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def shingles(text):
    words = WORD.findall(lower(text))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def jaccard(docs):
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc_id: (len(sets[doc_id]), find(doc_id)) for doc_id in sets}


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        names = ",".join(sorted(found))
        out[doc_id] = (len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out
