"""Secret scans against plain Python, and the trigram queries against the patterns."""

import hashlib
import random

import pytest

from eventpulse.llm.queries import op6
from eventpulse.llm.secrets import BASE_RULES, RULES, Rule, python_rules, trigram_query

SCHEMA = "doc_id bigint, text string"
PARTS = [
    "password", "PassWD", "secret", "Token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "abcdef", "12345678",
    "AKIA", "AKIAABCDEFGHIJKL", "deadbeef" * 4, "DEADBEEF", "é", "😀", "\n", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18,
    "xoxb-1234567890", "AIza" + "x" * 35, "eyJ" + "a" * 10 + "." + "b" * 10 + "." + "c" * 12, "K", "ſecret=abcdefghij",
]


def expected(text):
    spans = []
    for number, (rule, pattern) in enumerate(python_rules()):
        found = [m for m in pattern.finditer(text) if len(m.group(rule.group)) >= rule.least]
        spans += [(m.start(), number, m.end(), rule.kind) for m in found]
    spans.sort()
    joined = lambda some: ",".join(f"{k}:{a}:{b}" for a, _, b, k in some)
    base = [s for s in spans if s[1] < len(BASE_RULES)]
    counts = [sum(s[1] == i for s in base) for i in range(len(BASE_RULES))]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


def checked(spark, frame, tmp_path, rows):
    folder = tmp_path / "sf"
    frame(rows, SCHEMA).selectExpr("*", "'x' AS spans", "1 AS `key`", "2 AS rules").write.parquet(f"{folder}/documents.parquet")
    got = op6(spark, str(folder)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
    order = lambda t: (-1 if t[0] is None else t[0], t[1:])
    assert sorted(map(tuple, got), key=order) == sorted(((i, *expected(t or "")) for i, t in rows), key=order)


def test_generated_texts(spark, frame, tmp_path):
    dice = random.Random(1)
    rows = [(i % 190 if i % 11 else None, "".join(dice.choices(PARTS, k=dice.randint(0, 14)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "token=abcdefgh " * 4000), *rows[:9]]
    checked(spark, frame, tmp_path, rows)


def test_empty_table(spark, frame, tmp_path):
    checked(spark, frame, tmp_path, [])


def test_queries_of_the_rules():
    assert trigram_query("AKIA[A-Z0-9]+") == [frozenset([frozenset(["aki", "kia"])])]
    assert trigram_query("[0-9a-f]{32,}") == [] == trigram_query("ab|cde")
    assert trigram_query("x?abc(d|e)*fgh") == [frozenset([frozenset(["abc"])]), frozenset([frozenset(["fgh"])])]
    (words,) = trigram_query(BASE_RULES[0].pattern)
    assert {frozenset(["tok", "oke", "ken"]), frozenset(["sec", "ecr", "cre", "ret"])} <= words
    assert not any("tok" in s and len(s) > 3 for s in words)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.kind)
def test_every_match_meets_the_query(rule: Rule):
    dice = random.Random(2)
    pattern = dict((r.kind, p) for r, p in python_rules())[rule.kind]
    for _ in range(20_000):
        text = "".join(dice.choices(PARTS, k=5))
        if pattern.search(text):
            low = text.lower()
            for any_of in trigram_query(rule.pattern):
                assert any(all(t in low for t in s) for s in any_of)
