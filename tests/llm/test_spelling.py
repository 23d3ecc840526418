"""Spelling variants against all pairs; keys of edits against keys of the edited words."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import ODD_TEXTS, lost_letters, spelling_variants
from waybill.llm import spelling


def made_docs(seed=3, words=60, docs=80):
    """Texts over a few words and their variants by one or two edits, some of them much more frequent."""
    draw = random.Random(seed)
    letters = "abcé÷ñz"
    base = ["".join(draw.choices(letters, k=draw.randint(6, 9))) for _ in range(words)]
    for word in list(base):
        at = draw.randrange(len(word))
        base += [word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + "q" + word[at + 1 :]]
    weights = [draw.choice([1, 1, 8, 60]) for _ in base]
    texts = [" ".join(draw.choices(base, weights, k=draw.randint(0, 120))) for _ in range(docs)]
    return list(enumerate(texts))


def found(frame):
    return sorted(tuple(row) for row in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_match_all_pairs_with_lost_letters(spark):
    rows = made_docs() + [(None, "Sometext sometext SOMETEXT ÀÉsometext"), (7, None), (7, ""), (7, "x" * 40_000)]
    rows += [(1, "abcdef-Abcdef\nabcdef9abcdef_abcdef")] * 3 + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id bigint, text string, n int, word int")
    counts = lost_letters(rows, every=11)
    counted = spelling.word_counts(docs, letter_lost=11)
    assert {row.word: row.n for row in counted.collect()} == counts
    expected = spelling_variants(counts)
    assert sum(form is not None for _, form, *_ in expected) > 10
    assert found(spelling.variants(counted)) == expected


def test_chains_of_forms_ties_and_long_words(spark):
    long = "ab" * 3000
    counts = {
        "colour": 1, "colours": 5, "colourss": 25, "colourssx": 125, "colourssxy": 700,  # a chain of four forms
        "centre": 10, "bentre": 50, "dentre": 50,  # a tie goes to the least form
        "aaaaaa": 3, "aaaaaaa": 15,  # the same edit at several places
        long: 2, long[:4000] + "z" + long[4001:]: 10,
    }
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(spelling.variants(frame)) == spelling_variants(counts)


def test_filters_in_several_passes_find_the_same(spark, monkeypatch):
    counts = lost_letters(made_docs(5))
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    monkeypatch.setattr(spelling, "SHARD_WORDS", 16)
    monkeypatch.setattr(spelling, "PASS_BYTES", 3 * spelling.SHARD_BYTES)
    assert found(spelling.variants(frame)) == spelling_variants(counts)


def test_empty_tables_and_documents_without_words(spark):
    kind = "doc_id bigint, text string"
    for rows in ([], [(1, None), (None, ""), (2, "a b c 1 2 3")]):
        counted = spelling.word_counts(spark.createDataFrame(rows, kind), letter_lost=199)
        assert spelling.variants(counted).collect() == []


@pytest.mark.parametrize("word", ["abcdef", "àéñ÷zzz", "a", "abababababababab" * 30])
def test_keys_of_edits_are_keys_of_the_edited_words(word):
    def key(text):
        return int(spelling.keys(np.array([list(map(ord, text))], dtype=np.uint32).reshape(1, len(text)))[0])

    letters = np.array([list(map(ord, word))], dtype=np.uint32)
    assert spelling.deletions(letters)[0].tolist() == [key(word[:i] + word[i + 1 :]) for i in range(len(word))]
    for letter, place, keys in spelling.replacements(letters):
        assert place.tolist() == [i for i, x in enumerate(word) if ord(x) < letter]
        assert keys.tolist()[:3] == [key(word[:i] + chr(letter) + word[i + 1 :]) for i in place.tolist()[:3]]


def test_filters_hold_every_word_and_few_others(spark):
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("abcdefghij", k=8)) for _ in range(20_000)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    shards = spelling.layout(frame)
    rows = spelling.filter_bits(frame, shards).toArrow()
    table = np.zeros((shards.shards * spelling.BLOCKS, spelling.LANES), dtype=np.uint64)
    line = rows["shard"].to_numpy() * spelling.BLOCKS + rows["block"].to_numpy()
    for lane in range(spelling.LANES):
        table[line, lane] = rows[f"lane{lane}"].to_numpy().view(np.uint64)
    filters = spelling.Filters(shards, 0, shards.shards, table)
    (_, letters), = [*spelling.letter_groups(pa.array(words[:5000]))]
    assert len(filters.holds(spelling.keys(letters), 8)) == 5000
    others = np.random.default_rng(0).integers(97, 123, size=(50_000, 8)).astype(np.uint32)
    assert len(filters.holds(spelling.keys(others), 8)) < 200
    assert len(filters.holds(spelling.keys(others[:, :7]), 7)) == 0
