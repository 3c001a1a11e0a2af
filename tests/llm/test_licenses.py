"""License scans against a brute-force version without filters or hashes."""

import itertools
import math
import random
import re

from eventpulse.llm.licenses import BASE_PHRASES, BLOCK_WORDS, FAMILIES, LICENSE_TEXTS, NAMES, TEMPLATES, THRESHOLD, scan_licenses, windows
from eventpulse.llm.licenses import LicenseRules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(text):
    low = text.translate(LOWER)
    words = WORD.findall(low)
    places = [
        (i, label) for phrase, label in BASE_PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    labels, score = {x for _, x in places}, 1.0 if places else 0.0
    for line in low.split("\n"):
        own = WORD.findall(line)
        for a, b in windows(0, len(own)):
            block = set(own[a:b])
            for template, label in TEMPLATES:
                want = set(template.split())
                share = len(want & block) / len(want)
                if share >= THRESHOLD - 1e-12:
                    labels.add(label)
                    score = max(score, share)
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), score,
    )


def test_against_brute_force(spark, frame):
    dice = random.Random(3)
    pieces = [t for t, _ in TEMPLATES + BASE_PHRASES]
    vocabulary = sorted({w for t in pieces for w in t.split()}) + ["é", "word", "x1", "über"]

    def text():
        out = []
        for _ in range(dice.randint(0, 12)):
            words = dice.choice(pieces).split() if dice.random() < 0.5 else dice.choices(vocabulary, k=dice.randint(0, 90))
            words = [w.upper() if dice.random() < 0.1 else w for w in words if dice.random() > 0.07]
            out.append(dice.choice([" ", ", ", "-", ". "]).join(words))
        return dice.choice(["\n", " ", ".\n"]).join(out)

    rows = [(i if i % 13 else None, text()) for i in range(500)]
    rows += [(900, None), (901, ""), (902, "The MIT\nLicense"), (903, "mit license " * 30_000), *rows[:4]]
    got = scan_licenses(frame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS labels", "2 AS n_words"))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    order = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    have = sorted((tuple(r) for r in got.select(columns).collect()), key=order)
    want = sorted(((i, *expected(t or "")) for i, t in rows), key=order)
    for h, w in zip(have, want, strict=True):
        assert h[:7] == w[:7]
        assert abs(h[7] - w[7]) < 1e-12


def test_windows_hold_every_run():
    for n in range(0, 300):
        found = windows(0, n)
        run = BLOCK_WORDS // 2
        assert all(any(a <= i and i + run <= b for a, b in found) for i in range(n - run + 1))


def test_empty_table(frame):
    assert scan_licenses(frame([], "doc_id bigint, text string")).collect() == []


def blocks_across_lines(text):
    """Labels with first word and end of every block, of lines and of windows of 64 words each 32, by plain sets."""
    low = text.translate(LOWER)
    found, best, at = set(), 0.0, 0
    spans = []
    for line in low.split("\n"):
        n = len(WORD.findall(line))
        spans += [(at + i, min(at + n, at + i + 64)) for i in (range(0, n - 32, 32) if n > 64 else [0])]
        at += n
    spans += [(i, min(at, i + 64)) for i in (range(0, at - 32, 32) if at > 64 else [0])]
    words = WORD.findall(low)
    for a, b in spans:
        for template, label in TEMPLATES:
            want = set(template.split())
            share = len(want & set(words[a:b])) / len(want)
            if share >= THRESHOLD - 1e-12:
                found.add(f"{label}:{a}:{b}")
                best = max(best, share)
    return found, best


def test_templates_wrapped_over_lines(spark, frame):
    dice = random.Random(8)
    wrapped = [
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
        ("This work is licensed under the GNU General Public\nLicense, version 3", "gpl-3.0"),
        ("subject to the terms of\nthe Mozilla Public License", "mpl"),
    ]
    filler = lambda n: " ".join(f"w{dice.randrange(900)}" + dice.choice(["", "\n"]) for _ in range(n))
    rows = [(i, t, label) for i, (t, label) in enumerate(wrapped)]
    for i in range(3, 150):
        template, label = dice.choice(TEMPLATES)
        words = template.split()
        cut = dice.randrange(1, len(words))
        text = f"{filler(dice.randint(0, 200))} {' '.join(words[:cut])}\n{' '.join(words[cut:])} {filler(dice.randint(0, 90))}"
        rows.append((i, text, label))
    docs = frame([r[:2] for r in rows], "doc_id bigint, text string")
    got = {r.doc_id: r for r in scan_licenses(docs, rules=LicenseRules(across_lines=True)).collect()}
    for i, text, label in rows:
        found, best = blocks_across_lines(text)
        assert label in got[i].labels.split(",")
        assert set(filter(None, got[i].blocks.split(","))) == found
        assert abs(got[i].score - (1.0 if got[i].n_base else best)) < 1e-12


def test_query_scans_across_lines(spark, tmp_path):
    from eventpulse.llm.queries import op2

    text = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    spark.createDataFrame([(1, text)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [(r.labels, r.score) for r in op2(spark, str(tmp_path)).collect()] == [("bsd", 1.0)]


OWN = [
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software", "mit"),
    ("Licensed under CC BY 4.0", "cc-by,cc-by-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc-4.0"),
    ("Licensed under\nCC BY-SA 4.0", "cc-by,cc-by-sa-4.0"),
    ("released under the GNU General Public License", "gpl"),
    ("You can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl"),
    ("This work is licensed under the GNU Lesser General Public License, version 3", "lgpl"),
    ("under the terms of the GNU Affero General Public License", "agpl"),
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"),
    ("You reserved all your rights under law", ""),
    ("All rights reserved.", "proprietary"),
    ("the license was released, under which mitten is unclear", ""),
]


def judged(text):
    """Labels of the templates in a text of one block, judged by hand-made rules on plain lists."""
    rules = LicenseRules(templates=TEMPLATES + LICENSE_TEXTS)
    words = WORD.findall(text.translate(LOWER))
    labels = {label for phrase, label in BASE_PHRASES if f" {phrase} " in f" {' '.join(words)} "}
    held = []
    for template, label in rules.templates:
        own = template.split()
        shared = set(own) & set(words)
        least = math.ceil(THRESHOLD * len(set(own)) - 1e-9)
        telling = {w for w in own if w in NAMES or w.isdigit()}
        if len(shared) < least or not telling <= set(words):
            continue
        if len(own) <= 7:
            stretches = [words[i : i + len(own) + 2] for i in range(len(words))]
            choices = [c for n in range(least, len(own) + 1) for c in itertools.combinations(own, n)]

            def holds(stretch, choice):
                rest = iter(stretch)
                return all(w in rest for w in choice)

            if not any(holds(s, c) for s in stretches for c in choices):
                continue
        held.append((label, len(telling & NAMES), len(shared) / len(set(own)), len(shared)))
    for family in FAMILIES:
        mine = [h for h in held if h[0] in family]
        labels |= {h[0] for h in mine if h[1:] == max(x[1:] for x in mine)}
        held = [h for h in held if h[0] not in family]
    return ",".join(sorted(labels | {h[0] for h in held}))


def test_each_sentence_has_its_own_label(spark, tmp_path):
    from eventpulse.llm.queries import op2

    dice = random.Random(21)
    texts = [t for t, _ in OWN]
    for _ in range(400):
        words = dice.choice(TEMPLATES + LICENSE_TEXTS[2:])[0].split()
        words = [w for w in words if dice.random() > 0.12]
        for _ in range(dice.choice([0, 0, 1, 2, 5])):
            words.insert(dice.randint(0, len(words)), dice.choice(["lesser", "nc", "sa", "mit", "gnu", "3", "x", "y", "license"]))
        texts.append(" ".join(words + dice.choice(TEMPLATES)[0].split() * dice.choice([0, 0, 1])))
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.labels for r in op2(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(OWN))] == [label for _, label in OWN]
    assert {i: got[i] for i, t in rows if "\n" not in t} == {i: judged(t) for i, t in rows if "\n" not in t}


def test_long_templates_have_windows_of_their_length(frame):
    text, label = LICENSE_TEXTS[0]
    rules = LicenseRules(templates=LICENSE_TEXTS, across_lines=True, telling=True)
    filler = " ".join(f"w{i}" for i in range(201))
    rows = [(i, f"{' '.join(filler.split()[:i * 9])} {text} {filler}") for i in range(20)]
    rows += [(50, " ".join(text.split()[:30])), (51, text.replace(" ", "\n"))]
    got = {r.doc_id: r.labels for r in scan_licenses(frame(rows, "doc_id bigint, text string"), rules=rules).collect()}
    assert got == {i: "" if i == 50 else label for i, _ in rows}
