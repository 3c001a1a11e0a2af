"""Exact de-duplication against plain Python, and the listed SQL of this part."""

import hashlib
import random

import pytest
from compare import differences, duckdb_tables

from eventpulse.llm import exact_dedup
from eventpulse.llm.exact_dedup import exact_dedup as dedup
from eventpulse.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def check(frame, rows, keep, parts=7):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    docs = frame(rows, SCHEMA, parts).selectExpr("*", "1 AS run", "2 AS keep_id", "true AS kept", "3 AS digest")
    got = dedup(docs, keep=keep).collect()
    assert len(got) == len(rows)
    by_hash = {}
    for r in got:
        by_hash.setdefault(r.text_sha256, []).append(r)
    pick = max if keep == "largest" else min
    for text, ids in groups.items():
        found = by_hash.pop(hashlib.sha256(text.encode()).hexdigest())
        want = pick((i for i in ids if i is not None), default=None)
        assert sorted(r.doc_id if r.doc_id is not None else -1 for r in found) == sorted(-1 if i is None else i for i in ids)
        assert {(r.keep_id, r.group_size) for r in found} == {(want, len(ids))}
        assert [r.doc_id for r in found if r.kept] == [want]
    assert not by_hash


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_against_plain_python(frame, keep, monkeypatch):
    dice = random.Random(20)
    texts = ["", None, "a", "A", "É", "é", "same text", "SAME TEXT", "x" * 200_000, "X" * 200_000] + [f"t{i}" for i in range(40)]
    rows = [(dice.randrange(300) if dice.random() > 0.1 else None, dice.choice(texts)) for _ in range(600)]
    rows += [(7, "same text")] * 300 + [(None, "no id")] * 3
    check(frame, rows, keep, 20)
    monkeypatch.setattr(exact_dedup, "FAN", 2)
    check(frame, rows, keep, 11)


def test_empty_table(frame):
    check(frame, [], "largest")
    with pytest.raises(ValueError):
        dedup(frame([], SCHEMA), keep="newest")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    problems, _, _ = differences(spark, duckdb_tables(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir)
    assert problems == []
