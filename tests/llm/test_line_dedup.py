"""Line de-duplication against plain Python, and its query against its SQL."""

import random

from compare import differences, duckdb_tables

from eventpulse.llm.line_dedup import dedup_lines
from eventpulse.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK = " \t\n\x0b\x0c\r"


def key_of(line):
    return line.strip(BLANK).translate(LOWER)


def expected(rows, least_chars=20, least_docs=3):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders.setdefault(key_of(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")

        def stays(line, doc_id=doc_id):
            ids = holders.get(key_of(line), ())
            return len(ids) < least_docs or doc_id == max((i for i in ids if i is not None), default=None)

        kept = [x for x in lines if stays(x)]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


LINES = [
    "All rights reserved by the authors of it", "  ALL RIGHTS reserved by the authors of it\t", "short line", "", " ", "\x0b\x0c\r",
    "éééééééééééééééééééé", "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ", "é" * 19, "😀" * 20, "exactly twenty chars", "only nineteen chars",
    " not a blank of ours ", *(f"line number {i} of a longer list" for i in range(30)),
]


def test_against_plain_python(frame):
    dice = random.Random(12)
    rows = [(i % 90 if i % 17 else None, "\n".join(dice.choices(LINES, k=dice.randint(1, 9)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "\n".join(LINES * 500)), (504, "one long line " * 9000), (600, "\n".join(LINES)), *rows[:6]]
    docs = frame(rows, SCHEMA).selectExpr("*", "1 AS line", "2 AS `key`", "3 AS places", "4 AS n_lines", "5 AS dropped")
    got = [tuple(r) for r in dedup_lines(docs).collect()]
    assert in_order(got) == in_order(expected(rows))
    assert any(r[3] and not r[1] for r in got) and any(r[3] > 400 for r in got)


def test_other_limits_and_one_repeated_row(frame):
    rows = [(7, "the same\nrow again")] * 300 + [(8, "the same"), (9, "the same\nother")]
    assert in_order(tuple(r) for r in dedup_lines(frame(rows, SCHEMA), least_chars=5, least_docs=3).collect()) == in_order(
        expected(rows, 5, 3)
    )
    assert in_order(tuple(r) for r in dedup_lines(frame(rows, SCHEMA), least_chars=5, least_docs=4).collect()) == in_order(
        expected(rows, 5, 4)
    )


def test_no_id_at_all(frame):
    rows = [(None, "a line that is long enough")] * 5
    assert in_order(tuple(r) for r in dedup_lines(frame(rows, SCHEMA)).collect()) == in_order(expected(rows))


def test_empty_table(frame):
    assert dedup_lines(frame([], SCHEMA)).collect() == []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    name = "op12_line_dedup"
    problems, _, _ = differences(spark, duckdb_tables(folder), name, QUERIES[name], ORACLES[name], folder)
    assert problems == []
