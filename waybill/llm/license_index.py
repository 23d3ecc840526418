"""Licence scans: a positional index of rare licence words, with verification of key phrases.

Every word of every licence template is indexed with its positions and its inverse document frequency
over all documents. Of each text, the rarest of its own licence words are looked up: for each template
as many as any match of enough weight must hold. Places where two of them agree, give or take a few
words, on where the template would begin are aligned with it in a band, so that words put in, left out
or changed cost their weight and no more. A template counts when enough of its weight matches and each
of its mandatory key phrases stands near its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.hashing import Run, runs, word_hashes

#: The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices as their licences word them, whole and their opening words alone, each with the
#: phrases that it must hold.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license",
        ("apache license", "except in compliance"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
        ("free software", "gnu general public license"),
    ),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        ("gnu lesser general public license",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("source and binary forms", "following conditions are met"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted",
        ("for any purpose with or without fee",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license",
        ("mozilla public license",),
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    (
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including"
        " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
        " copies of the software and to permit persons to whom the software is furnished to do so subject to"
        " the following conditions the above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the software",
        ("permission is hereby granted", "shall be included in all copies"),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license you may obtain a copy of the license at http www apache org licenses"
        " license 2 0 unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind either express"
        " or implied see the license for the specific language governing permissions and limitations under the"
        " license",
        ("apache license", "governing permissions and limitations"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 3 of the license"
        " or at your option any later version this program is distributed in the hope that it will be useful"
        " but without any warranty without even the implied warranty of merchantability or fitness for a"
        " particular purpose see the gnu general public license for more details",
        ("free software foundation", "gnu general public license"),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met redistributions of source code must retain the above"
        " copyright notice this list of conditions and the following disclaimer redistributions in binary form"
        " must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution",
        ("source and binary forms", "must retain the above copyright notice"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted provided that the above copyright notice and this permission notice appear in all"
        " copies",
        ("for any purpose with or without fee",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the"
        " mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify"
        " publish use compile sell or distribute this software either in source code form or as a compiled"
        " binary for any purpose commercial or non commercial and by any means",
        ("free and unencumbered software",),
    ),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)
#: The least share of a template's weight that matches, and how many words parts of a notice may shift.
LEAST_SCORE, SHIFT = 0.6, 8
#: Places aligned at once, which bounds the memory.
_BLOCK = 4096


@dataclass(frozen=True)
class Template:
    label: str
    hashes: np.ndarray
    weights: np.ndarray
    phrases: tuple[tuple[int, int], ...]
    #: Its positions, those of the rarest words first, and the index's number of the word at each.
    rarest: np.ndarray
    word: np.ndarray


class Index:
    """The templates' words, sorted by hash, with their weights and the templates they stand in."""

    def __init__(self, document_words: dict[str, int], documents: int, templates=TEMPLATES):
        self.words = np.unique(np.concatenate([word_hashes(text) for _, text, _ in templates]))
        self.templates: list[Template] = []
        #: Weight that a text can match of each template (columns) by holding a word (rows).
        self.holds = np.zeros((len(self.words), len(templates)))
        for number, (label, text, mandatory) in enumerate(templates):
            words, hashes = text.split(), word_hashes(text)
            weights = np.array([np.log((documents + 1) / (document_words.get(w, 0) + 1)) + 1e-9 for w in words])
            spans = []
            for phrase in mandatory:
                parts = phrase.split()
                at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
                spans.append((at, at + len(parts)))
            word = np.searchsorted(self.words, hashes)
            np.add.at(self.holds[:, number], word, weights)
            rarest = np.lexsort((word, -weights))
            self.templates.append(Template(label, hashes, weights, tuple(spans), rarest, word))
        self.totals = np.array([t.weights.sum() for t in self.templates])

    def candidates(self, run: Run) -> Iterator[tuple[int, int, np.ndarray]]:
        """(template, text, places where the template may begin, before the text or inside it)."""
        at = np.minimum(np.searchsorted(self.words, run.word_hash), len(self.words) - 1)
        place = np.flatnonzero(self.words[at] == run.word_hash)
        key = run.word_text[place] * len(self.words) + at[place]
        order = np.argsort(key, kind="stable")
        place = place[order]
        key, first, many = np.unique(key[order], return_index=True, return_counts=True)
        text, word = np.divmod(key, len(self.words))
        texts, rows = np.unique(text, return_index=True)
        if not len(texts):
            return
        # Templates of which a text holds too little, wherever it stands, are passed over.
        reach = np.add.reduceat(self.holds[word], rows, axis=0)
        for row, number in zip(*np.nonzero(reach >= LEAST_SCORE * self.totals - 1e-9), strict=True):
            own = slice(rows[row], rows[row + 1] if row + 1 < len(rows) else len(word))
            places = {w: place[f : f + n] for w, f, n in zip(word[own], first[own], many[own], strict=True)}
            looked_up, agreeing = self.lookups(number, places, reach[row, number])
            template = self.templates[number]
            begins = np.sort(np.concatenate([places[template.word[i]] - i for i in looked_up]))
            if agreeing:
                close = np.diff(begins) <= SHIFT
                begins = begins[np.concatenate([[False], close]) | np.concatenate([close, [False]])]
            if len(begins):
                yield int(number), int(texts[row]), np.unique(begins)

    def lookups(self, number: int, held, reach: float) -> tuple[np.ndarray, bool]:
        """The template's positions to look up in a text that holds the words `held`, rarest first.

        A match may miss what the threshold leaves, less what the text does not hold at all. So many
        positions are taken that it cannot miss all but one of them: two must then agree. Where the
        text holds too little for that, it cannot miss all of them, and one is enough.
        """
        template = self.templates[number]
        positions = np.array([i for i in template.rarest if template.word[i] in held])
        missed = reach - LEAST_SCORE * self.totals[number] + 1e-9
        sums = np.cumsum(template.weights[positions])
        enough = np.flatnonzero(sums - template.weights[positions[0]] > missed)
        agreeing = len(enough) > 0
        if not agreeing:
            enough = np.flatnonzero(sums > missed)
        return positions[: enough[0] + 1] if len(enough) else positions, agreeing

    def aligned(self, run: Run, number: int, begins: np.ndarray, low: int, high: int) -> np.ndarray:
        """The share of the template's weight matched from each place on, 0 without its key phrases.

        The heaviest alignment that keeps the order of the words, each of them at most `SHIFT` words
        from its place; `low` and `high` bound the text's words.
        """
        template = self.templates[number]
        shifts = np.arange(-SHIFT, SHIFT + 1)
        best = np.zeros((len(begins), len(shifts)))
        stands = [np.ones((len(begins), len(shifts)), dtype=bool) for _ in template.phrases]
        for i, (want, weight) in enumerate(zip(template.hashes, template.weights, strict=True)):
            at = begins[:, None] + (i + shifts)
            same = (at >= low) & (at < high)
            same[same] = run.word_hash[at[same]] == want
            for span, stand in zip(template.phrases, stands, strict=True):
                if span[0] <= i < span[1]:
                    stand &= same
            skipped = np.concatenate([best[:, 1:], best[:, -1:]], axis=1)
            best = np.maximum(skipped, best + weight * same)
            best = np.maximum.accumulate(best, axis=1)
        whole = np.all([stand.any(axis=1) for stand in stands], axis=0) if stands else True
        return np.where(whole, np.minimum(best.max(axis=1) / self.totals[number], 1.0), 0.0)

    def scan(self, run: Run) -> tuple[list[set[str]], np.ndarray]:
        """Labels and the best score of each text."""
        labels: list[set[str]] = [set() for _ in range(run.texts)]
        scores = np.zeros(run.texts)
        ends = np.cumsum(run.words)
        for number, text, begins in self.candidates(run):
            low, high = int(ends[text] - run.words[text]), int(ends[text])
            blocks = (begins[i : i + _BLOCK] for i in range(0, len(begins), _BLOCK))
            score = max(float(self.aligned(run, number, block, low, high).max()) for block in blocks)
            if score >= LEAST_SCORE - 1e-12:
                labels[text].add(self.templates[number].label)
                scores[text] = max(scores[text], score)
        return labels, scores


def frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each template word stands, and the number of documents; a job over all.

    A task counts its documents for the templates' few hundred words; only the sums reach the driver.
    """
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    hashes = np.array([word_hashes(w)[0] for w in vocabulary], dtype=np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(vocabulary), dtype=np.int64), 0
        for batch in batches:
            for _, run in runs(batch.column(0), lowered=True, blank_words=False):
                at = np.minimum(np.searchsorted(hashes, run.word_hash), len(hashes) - 1)
                known = hashes[at] == run.word_hash
                seen = np.unique(run.word_text[known] * len(hashes) + at[known]) % len(hashes)
                total += np.bincount(seen, minlength=len(hashes))
                texts += run.texts
        names = [vocabulary[i] for i in order] + [""]
        yield pa.RecordBatch.from_pydict({"word": names, "n": [*total.tolist(), texts]})

    counts = docs.select("text").mapInArrow(count, "word string, n bigint")
    found = {row.word: row.n for row in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.get("", 0)


def _base(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[str]]]:
    """Places of the base phrases in each text, the first and the last, and their labels."""
    text_of, hashes = run.word_text, run.word_hash
    labels: list[set[str]] = [set() for _ in range(run.texts)]
    places = []
    for phrase, label in PHRASES:
        want = word_hashes(phrase)
        at = np.flatnonzero(hashes == want[0])
        at = at[at + len(want) <= len(hashes)]
        for i, word in enumerate(want[1:], 1):
            at = at[(hashes[at + i] == word) & (text_of[at + i] == text_of[at])]
        for text in np.unique(text_of[at]):
            labels[text].add(label)
        places.append(at)
    at = np.concatenate(places)
    first_of = np.cumsum(run.words) - run.words
    text = text_of[at]
    start = at - first_of[text]
    first, last = np.full(run.texts, np.iinfo(np.int64).max), np.full(run.texts, -1)
    np.minimum.at(first, text, start)
    np.maximum.at(last, text, start)
    return np.bincount(text, minlength=run.texts), first, last, labels


_RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double"
)


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Base places, labels and score of every document, in Arrow batches, without a shuffle.

    Null and empty texts have no words and no labels. A text of base phrases scores 1 by them, like a
    whole template. Repeated rows and null ids come back as given; other columns are not read.
    """
    counted, documents = frequencies(docs, templates)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(counted, documents, templates)
        for batch in batches:
            for row, run in runs(batch.column("text"), lowered=True, blank_words=False):
                n_base, first, last, base = _base(run)
                labels, scores = index.scan(run)
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, run.texts),
                        pa.array(run.words.astype(np.int64)),
                        pa.array(n_base.astype(np.int64)),
                        pa.array(first, mask=none, type=pa.int64()),
                        pa.array(last, mask=none, type=pa.int64()),
                        pa.array([",".join(sorted(found)) for found in base], type=pa.string()),
                        pa.array(
                            [",".join(sorted(a | b)) for a, b in zip(base, labels, strict=True)], type=pa.string()
                        ),
                        pa.array(np.where(none, scores, 1.0)),
                    ],
                    names=[part.split()[0] for part in _RESULT.split(", ")],
                )

    return docs.select("doc_id", "text").mapInArrow(find, _RESULT)
