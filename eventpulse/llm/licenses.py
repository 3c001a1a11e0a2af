"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line of a text; a line of more than 64 words, or twice the longest template, is cut into
overlapping windows, so that any run of words as long as a template lies in one block
whole. Headers are often wrapped, so with ``across_lines`` the same windows are also
laid over a whole text, line feeds or not. A template is found in a block that holds at least ``THRESHOLD`` of its
distinct words. Words are ordered by how often the whole corpus has them, the rarest
first. A block that meets the threshold must hold one of a template's few first words
(prefix filter), must have enough distinct words (length filter), and from the place
of the first shared word on both sides must have enough words left (position filter).
What passes is counted exactly. Templates are a fixed list of a few hundred words; it
is the only thing sent to all tasks, with one count per word of it.

A set of words says little about a short sentence, or about one of several that differ in a word.
With ``telling``, what the join finds is judged further: the words that name a license, and numbers,
must all be there; the words of a short template must stand in order and close together; and of the
templates of one family the block keeps the one with most of the names that it holds.

Beside this join, places are listed where a base phrase's words stand consecutively.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches
from .words import ALNUM, chunks, lowered, text_bytes, word_bounds, word_hashes

THRESHOLD = 0.8
BLOCK_WORDS = 64

# Fixed phrases and labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Usual sentences of licenses, at most BLOCK_WORDS / 2 words each, and the labels that the join gives.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("creative commons attribution license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "proprietary"),
)
# Whole paragraphs of license texts, for which windows are as long as they need.
LICENSE_TEXTS = (
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the"
        " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
        " persons to whom the software is furnished to do so subject to the following conditions",
        "mit",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    ("released under the gnu general public license", "gpl"),
)
# Fixed lists: words that name a license, and labels of which a sentence has one.
NAMES = frozenset("mit apache gnu lesser affero cc nc sa creative commons mozilla".split())
FAMILIES = (("gpl", "gpl-3.0", "lgpl", "agpl"), ("cc-by", "cc-by-4.0", "cc-by-nc-4.0", "cc-by-sa-4.0"))
# Templates of at most so many words must be found in order, with so many words between at most.
SHORT_WORDS, BETWEEN = 7, 2


@dataclass(frozen=True)
class LicenseRules:
    phrases: tuple[tuple[str, str], ...] = BASE_PHRASES
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    threshold: float = THRESHOLD
    across_lines: bool = False  # windows over whole texts beside those of lines
    telling: bool = False  # judge by names, order and family what the join finds

    @cached_property
    def block_words(self) -> int:
        """Any run of words as long as the longest template lies whole in one of two overlapping windows."""
        return max(BLOCK_WORDS, 2 * max((len(text.split()) for text, _ in self.templates), default=0))

    @cached_property
    def words(self) -> list[str]:
        return sorted({w for text, _ in self.phrases + self.templates for w in text.split()})


class _Reader:
    """Numbers the words of a chunk of texts: the place in the list of rule words, or -1."""

    def __init__(self, rules: LicenseRules):
        data = pa.array(rules.words, pa.large_string())
        raw, bounds = text_bytes(data)
        hashes = word_hashes(raw, bounds[:-1], bounds[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.words = [w.encode() for w in rules.words]
        # Most words are none of the rules': a table over 16 bits of the hash says so at once.
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[hashes & np.uint64(0xFFFF)] = True

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = word_hashes(data, starts, ends)
        numbers = np.full(len(starts), -1, np.int32)
        some = np.flatnonzero(self.maybe[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        equal = self.hashes[at] == hashes[some]
        numbers[some[equal]] = self.order[at[equal]]
        return numbers


def _word_counts(rules: LicenseRules):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = _Reader(rules), np.zeros(len(rules.words), np.int64)
        for batch in batches:
            for _, texts in chunks(lowered(batch.column("text"))):
                data, docs = text_bytes(texts)
                numbers = reader.numbers(data, *word_bounds(data, docs, ALNUM)[:2])
                total += np.bincount(numbers[numbers >= 0], minlength=len(total))
        yield pa.record_batch([pa.array(rules.words), pa.array(total)], names=["word", "n"])

    return counts


def word_frequencies(texts: DataFrame, rules: LicenseRules) -> dict[str, int]:
    """How often the corpus has each word of the rules. One row per rule word reaches the driver."""
    counted = texts.mapInArrow(_word_counts(rules), "word string, n bigint")
    return {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class _Template:
    label: str
    words: tuple[int, ...]  # numbers of its distinct words, rarest first
    least: int  # words that a block must share
    text: tuple[int, ...]  # all its words in order
    names: frozenset[int]
    must: frozenset[int]  # names and numbers
    family: int | str


def _in_order(words: tuple[int, ...], least: int, block: np.ndarray) -> bool:
    """Whether so many of the words stand in their order within a stretch of the block little longer than they are."""
    reach, some = len(words) + BETWEEN, set(words)
    for start in np.flatnonzero(np.isin(block, words)).tolist():
        row = [0] * (len(words) + 1)  # longest common subsequence
        for word in block[start : start + reach].tolist():
            if word in some:
                row = [0, *itertools.accumulate(
                    zip(words, row, row[1:]), lambda last, x: max(last, x[2], x[1] + 1 if x[0] == word else 0), initial=0
                )][1:]
        if row[-1] >= least:
            return True
    return False


class _Join:
    """The templates by the words of their prefixes."""

    def __init__(self, rules: LicenseRules, frequencies: dict[str, int]):
        numbers = {w: i for i, w in enumerate(rules.words)}
        rank = sorted(numbers, key=lambda w: (frequencies.get(w, 0), w))
        self.rank = {numbers[w]: i for i, w in enumerate(rank)}
        self.by_prefix: dict[int, list[tuple[int, _Template]]] = {}
        self.telling = rules.telling
        for text, label in rules.templates:
            words = tuple(sorted({numbers[w] for w in text.split()}, key=self.rank.get))
            least = max(1, int(np.ceil(rules.threshold * len(words) - 1e-9)))
            text_words = tuple(numbers[w] for w in text.split())
            names = frozenset(numbers[w] for w in text.split() if w in NAMES)
            must = names | {numbers[w] for w in text.split() if w.isdigit()}
            family = next((i for i, labels in enumerate(FAMILIES) if label in labels), label)
            template = _Template(label, words, least, text_words, names, must, family)
            for place, word in enumerate(words[: len(words) - least + 1]):
                self.by_prefix.setdefault(word, []).append((place, template))
        self.prefix_words = np.array(sorted(self.by_prefix), np.int32)

    def found(self, block: np.ndarray) -> dict[str, float]:
        """Label and containment of each template that the block holds; -1 stands for words of no rule."""
        n_words = len(block)
        words = sorted(set(block[block >= 0].tolist()), key=self.rank.get)
        seen, held = set(words), []
        tried = set()
        for place, word in enumerate(words):
            for template_place, template in self.by_prefix.get(word, ()):
                if template in tried:
                    continue
                tried.add(template)
                # The word is the first that both share, so the rest must hold what is missing.
                left = 1 + min(len(template.words) - template_place - 1, len(words) - place - 1)
                if n_words < template.least or left < template.least:
                    continue
                shared = sum(w in seen for w in template.words)
                if shared >= template.least:
                    held.append((template, shared))
        if self.telling:
            held = self._judged(held, seen, block)
        found: dict[str, float] = {}
        for template, shared in held:
            found[template.label] = max(found.get(template.label, 0.0), shared / len(template.words))
        return found

    @staticmethod
    def _judged(held: list[tuple[_Template, int]], seen: set[int], block: np.ndarray) -> list[tuple[_Template, int]]:
        held = [
            (t, n) for t, n in held
            if t.must <= seen and (len(t.text) > SHORT_WORDS or _in_order(t.text, t.least, block))
        ]
        best: dict[int | str, int] = {}
        for t, _ in held:
            best[t.family] = max(best.get(t.family, 0), len(t.names))
        held = [(t, n) for t, n in held if len(t.names) == best[t.family]]
        # Of a family's templates with as many names, the one that says most.
        most: dict[int | str, tuple[float, int]] = {}
        for t, n in held:
            most[t.family] = max(most.get(t.family, (0.0, 0)), (n / len(t.words), n))
        return [(t, n) for t, n in held if isinstance(t.family, str) or (n / len(t.words), n) == most[t.family]]


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
    " labels string, score double, blocks string"
)


def windows(low: int, high: int, size: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """The blocks of a line whose words are numbered from ``low`` up to ``high``."""
    if high - low <= size:
        return [(low, high)]
    step = size // 2
    return [(i, min(high, i + size)) for i in range(low, high - step, step)]


def _scan(rules: LicenseRules, frequencies: dict[str, int]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, join = _Reader(rules), _Join(rules, frequencies)
        place_of = {w: i for i, w in enumerate(rules.words)}
        phrases = [([place_of[w] for w in text.split()], label) for text, label in rules.phrases]
        is_prefix = np.zeros(len(rules.words) + 1, bool)
        is_prefix[join.prefix_words] = True
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in chunks(lowered(batch.column("text"))):
                part = ids[first : first + len(texts)]
                yield _scanned(reader, join, phrases, is_prefix, part, texts, rules)

    return scan


def _text_windows(line: np.ndarray, at_prefix: np.ndarray, doc_words: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """Text, begin and end of the windows over texts of several lines that hold a prefix word."""
    step = size // 2
    bounds = np.searchsorted(at_prefix, doc_words)
    for doc in np.flatnonzero(np.diff(bounds)).tolist():
        low, high = int(doc_words[doc]), int(doc_words[doc + 1])
        if line[low] == line[high - 1]:
            continue
        blocks = windows(low, high, size)
        spot = (at_prefix[bounds[doc] : bounds[doc + 1]] - low) // step
        held = np.unique(np.concatenate((spot - 1, spot)))
        held = held[(held >= 0) & (held < len(blocks))] if len(blocks) > 1 else np.zeros(1, np.int64)
        for i in held.tolist():
            yield doc, *blocks[i]


def _scanned(reader, join, phrases, is_prefix, ids, texts, rules) -> pa.RecordBatch:
    data, docs = text_bytes(texts)
    starts, ends, doc_words = word_bounds(data, docs, ALNUM)
    numbers = reader.numbers(data, starts, ends)
    n_docs = len(ids)
    n_words = np.diff(doc_words)
    base: list[list[tuple[int, str]]] = [[] for _ in range(n_docs)]
    for words, label in phrases:
        if len(numbers) < len(words):
            continue
        hit = numbers[: len(numbers) - len(words) + 1] == words[0]
        for i, word in enumerate(words[1:], 1):
            hit &= numbers[i : len(numbers) - len(words) + 1 + i] == word
        for at in np.flatnonzero(hit).tolist():
            doc = int(np.searchsorted(doc_words, at, side="right")) - 1
            if at + len(words) <= doc_words[doc + 1]:
                base[doc].append((at - int(doc_words[doc]), label))

    # Lines: of each word, the number of line feeds and texts begun before it.
    breaks = np.zeros(len(data) + 1, np.int32)
    breaks[:-1] = data == 10
    np.add.at(breaks, docs, 1)
    line = np.cumsum(breaks)[starts]
    found: list[dict[str, float]] = [{} for _ in range(n_docs)]
    blocks: list[list[str]] = [[] for _ in range(n_docs)]
    at_prefix = np.flatnonzero(is_prefix[numbers])

    def compare(doc: int, begin: int, end: int) -> None:
        own = numbers[begin:end]
        if not is_prefix[own].any():
            return
        for label, score in join.found(own).items():
            found[doc][label] = max(found[doc].get(label, 0.0), score)
            blocks[doc].append(f"{label}:{begin - int(doc_words[doc])}:{end - int(doc_words[doc])}")

    done = -1
    for at in at_prefix.tolist():
        if at <= done:
            continue
        low, high = (int(x) for x in np.searchsorted(line, [line[at], line[at] + 1]))
        done = high - 1
        doc = int(np.searchsorted(doc_words, at, side="right")) - 1
        for begin, end in windows(low, high, rules.block_words):
            compare(doc, begin, end)
    if rules.across_lines:
        for doc, begin, end in _text_windows(line, at_prefix, doc_words, rules.block_words):
            compare(doc, begin, end)
    rows = []
    for i, doc_id in enumerate(ids):
        places = [p for p, _ in base[i]]
        labels = {label for _, label in base[i]}
        score = 1.0 if places else 0.0
        rows.append((
            doc_id, int(n_words[i]), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | set(found[i]))),
            max([score, *found[i].values()]), ",".join(dict.fromkeys(blocks[i])),
        ))
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.string()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LicenseRules = LicenseRules()
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    A-Z count as lower case; words are runs of digits, letters and characters beyond
    ASCII. ``n_base`` counts all places of base phrases, which may cross lines;
    ``first_word`` and ``last_word`` are their least and greatest start, null if there
    are none. ``labels`` holds the base labels and those of templates found in blocks;
    ``score`` is the greatest containment, 1 with a base phrase, 0 with nothing.
    ``blocks`` lists label, first word and end of each block found, lines first; with
    ``rules.across_lines`` a template may be listed by its line and by windows. A null text is
    empty; null and repeated ids are kept; other columns are ignored.
    """
    in_small_batches(docs)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frequencies = word_frequencies(texts.select("text"), rules)
    return texts.mapInArrow(_scan(rules, frequencies), SCHEMA)
