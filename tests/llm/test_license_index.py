import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS, words
from waybill.llm import license_index
from waybill.llm.hashing import runs

BSD = next(text for label, text, _ in license_index.TEMPLATES if label == "bsd")
GPL = next(text for label, text, _ in license_index.TEMPLATES if label == "gpl")
DOCS = [
    *enumerate(ODD_TEXTS),
    (100, "intro words. " + BSD.upper().replace(" ", ", ") + " the end"),
    (101, "Licensed under GNU General\nPublic-License; apache license! cc by, CC BY. gnu general public"),
    (102, GPL.replace("redistribute it", "redistribute this") + " " + BSD),
    (103, " ".join(BSD.split()[::-1])),
    (104, BSD.replace("source and binary forms", "source and other forms")),
    (105, "All rights reserved."),
    (106, "all those rights were reserved"),
    (107, "mit " * 30000 + "license"),
    (108, "redistribution binary modification permitted"),
    (108, "MIT License"),
    (108, "MIT License"),
    (None, "released under the MIT license"),
]


def base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in license_index.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.fixture
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string")
    return frame.withColumns({"score": F.lit("s"), "n_words": F.lit(0), "word": F.lit(1)})


def test_base_against_brute_force(docs):
    got = sorted(
        str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
        for r in license_index.scan(docs).collect()
    )
    assert got == sorted(str((i, *base(text))) for i, text in DOCS)


def test_templates(docs):
    rows = {}
    for r in license_index.scan(docs).collect():
        rows.setdefault(r.doc_id, r)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    assert rows[100].labels == "bsd" and rows[100].score == pytest.approx(1.0)
    assert rows[102].labels == "bsd,gpl"
    assert rows[105].labels == "proprietary"
    for doc_id in (103, 104, 106):
        assert rows[doc_id].labels == ""


def test_frequencies_count_all_documents(docs):
    counted, documents = license_index.frequencies(docs)
    assert documents == len(DOCS)
    for word in ("license", "gnu", "redistribution", "the"):
        assert counted[word] == sum(word in words(text) for _, text in DOCS)


def heaviest(words, hashes, weights, begin, low, high):
    """Weighted longest common subsequence with shifts from `low` to `high`, by plain dynamic programming."""
    best = {}
    for i, (word, weight) in enumerate(zip(hashes, weights, strict=True)):
        for d in range(low, high + 1):
            at = begin + i + d
            same = 0 <= at < len(words) and words[at] == word
            over = best.get((i - 1, d + 1), 0.0) if d < high else 0.0
            besides = best.get((i, d - 1), 0.0) if d > low else 0.0
            best[i, d] = max(over, besides, best.get((i - 1, d), 0.0) + weight * same)
    return max(best[len(hashes) - 1, d] for d in range(low, high + 1))


def plain_scores(text, templates, weight_of, low, high):
    """The best score by label over all places, with key phrases near their place."""
    w, out = words(text), {}
    for label, template, mandatory in templates:
        t = template.split()
        weights = [weight_of[x] for x in t]
        for begin in range(-len(t), len(w) + len(t)):
            whole = True
            for phrase in mandatory:
                p = phrase.split()
                at = next(i for i in range(len(t)) if t[i : i + len(p)] == p)
                near = (begin + at + d for d in range(low, high + 1))
                whole &= any(k >= 0 and w[k : k + len(p)] == p for k in near)
            score = heaviest(w, t, weights, begin, low, high) / sum(weights) if whole else 0.0
            if score >= license_index.LEAST_SCORE:
                out[label] = max(out.get(label, 0.0), score)
    return out


SMALL = (
    ("ab", "one two three four five six seven eight nine ten eleven twelve", ("two three", "nine ten")),
    ("cd", "one one two seven seven zero", ("one two",)),
    ("ef", "six six", ()),
)


def test_alignment_against_brute_force(spark):
    rng = random.Random(7)
    texts = ["", "six six", "one two three", *(" ".join(t.split()[1:]) for _, t, _ in SMALL)]
    for _ in range(120):
        w = rng.choice(SMALL)[1].split()
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [rng.choice("one two six seven other words".split())] * rng.randrange(4)
        texts.append(" ".join(["pre"] * rng.randrange(3) + w + ["and"] * rng.randrange(3)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted, documents = license_index.frequencies(docs, SMALL)
    weight_of = {w: math.log((documents + 1) / (n + 1)) + 1e-9 for w, n in counted.items()}
    shift, found = license_index.SHIFT, 0
    for row in license_index.scan(docs, SMALL).collect():
        # All that shifts by `SHIFT` words in all is found; nothing that shifts further to both sides.
        least = plain_scores(texts[row.doc_id], SMALL, weight_of, 0, shift)
        most = plain_scores(texts[row.doc_id], SMALL, weight_of, -shift, shift)
        got = set(filter(None, row.labels.split(",")))
        assert least.keys() <= got <= most.keys(), texts[row.doc_id]
        if got:
            found += 1
            assert max(least.values(), default=0) - 1e-9 <= row.score <= max(most.values()) + 1e-9
    assert found > 40


@pytest.mark.parametrize("number", range(len(license_index.TEMPLATES)))
def test_notices_with_a_word_put_in_left_out_or_changed(number):
    label, text, mandatory = license_index.TEMPLATES[number]
    w, texts = text.split(), [text]
    place = {p: len(text[: text.find(p)].split()) for p in mandatory}
    for at in range(1, len(w)):
        for new in ([w[at], "inserted"], [], ["changed"]):
            texts.append(" ".join(["intro", *w[:at], *new, *w[at + 1 :], "tail"]))
    # A key phrase has to stand whole, and each word of a short notice may weigh too much.
    stands = lambda t, p: p in t and len(t[: t.find(p)].split()) <= place[p] + 2
    texts = [t for t in texts if t == text or len(w) > 8 and all(stands(t, p) for p in mandatory)]
    index = license_index.Index(dict.fromkeys(w, 1), 1000)
    for _, run in runs(pa.array(texts), lowered=True, blank_words=False):
        labels, scores = index.scan(run)
        assert all(label in found for found in labels) and scores.min() >= license_index.LEAST_SCORE


def test_each_file_is_looked_up_by_its_own_rarest_words():
    counted = {"released": 9, "under": 9, "the": 9, "mit": 1, "license": 2}
    index = license_index.Index(counted, 10, license_index.TEMPLATES[:1])
    template = index.templates[0]
    everything = set(template.word.tolist())
    looked_up, agreeing = index.lookups(0, everything, index.totals[0])
    assert agreeing and looked_up[:2].tolist() == [3, 4]
    without_mit = everything - {template.word[3]}
    assert 3 not in index.lookups(0, without_mit, index.totals[0] - template.weights[3])[0]


def test_empty_table(docs):
    assert license_index.scan(docs.limit(0)).count() == 0
