"""Plain Python versions of what the operators return, for small tables."""

import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Texts that have broken word rules before: blanks of all kinds, touching texts, other alphabets.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "One TWO three", "É É é", "a\x0bb\x1cc d", "漢字 漢字　x", "x" * 5000,
    "a b c d e a b c d e a b c d e", "l\nl\nl\n \n", "#*$ %&|<>", "don't  stop\t\tnow ", "ends with blank ",
    "MIT License", "the mit\nlicense, CC-BY, cc by", "<|endoftext|> a", "﻿b o m",
]


def words(text):
    return _WORD.findall((text or "").translate(LOWER))


def blank_words(text):
    return _BLANK_WORD.findall(text or "")


def contamination(text, items, n=13):
    """(words, hit words, items hit) for items as (id, text) pairs."""
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        i = words(item)
        k = min(n, len(i))
        windows = {tuple(i[j : j + k]) for j in range(len(i) - k + 1)} if k else set()
        for j in range(len(w) - k + 1 if k else 0):
            if tuple(w[j : j + k]) in windows:
                hit.update(range(j, j + k))
                found.add(item_id)
    return len(w), len(hit), found


def rule_counts(text):
    w = blank_words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if blank_words(line)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def labelled_shingles(text):
    w, seen, out = words(text), Counter(), set()
    for i in range(len(w) - 4) if len(w) >= 5 else range(bool(w)):
        shingle = tuple(w[i : i + 5])
        out.add((shingle, seen[shingle]))
        seen[shingle] += 1
    return out


def near_classes(texts, least=0.8):
    """Class (least id) of each id, by comparing all pairs."""
    of = {i: i for i in texts}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    shingles = {i: labelled_shingles(t) for i, t in texts.items()}
    ids = sorted(i for i in texts if shingles[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(shingles[a] & shingles[b])
            if both >= least * (len(shingles[a]) + len(shingles[b]) - both):
                x, y = sorted((root(a), root(b)))
                of[y] = x
    return {i: root(i) for i in texts}


def lost_letters(rows, every=199, least_length=6, least_count=5):
    """Counts of words of (doc_id, text) rows, after every so-manieth run by its hash lost a letter."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1 :] if h % every == 0 else run
            counts[word] += len(word) >= least_length
    return {word: n for word, n in counts.items() if n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelling_variants(counts, times=5):
    """(word, form, root, n, n_near, form_n) of every word, by comparing all pairs."""
    forms, near_counts = {}, {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        near_counts[word] = len(near)
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best and counts[best] >= times * n else None
    out = []
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        out.append((word, form, root, n, near_counts[word], counts[form] if form else None))
    return sorted(out)


def lexical_ranking(docs, items, keep=10):
    """(item_id, rank, doc_id, score) for docs and items as (id, text) pairs."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counted = [(doc_id, Counter(term.findall((text or "").translate(LOWER)))) for doc_id, text in docs]
    counted = [(doc_id, tf) for doc_id, tf in counted if tf]
    n_docs, n_terms = len(counted), sum(sum(tf.values()) for _, tf in counted)
    df = Counter(t for _, tf in counted for t in tf)
    out = []
    for item_id, text in items:
        wanted = Counter(term.findall((text or "").translate(LOWER)))
        scored = []
        for doc_id, tf in counted:
            m = 25 + 75 * sum(tf.values()) * n_docs // n_terms
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t, q in wanted.items()
                if t in tf
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:keep], 1):
            out.append((item_id, rank, doc_id, -score))
    return out
