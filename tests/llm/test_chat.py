"""Chat formatting against plain Python."""

import hashlib

from eventpulse.llm import chat
from eventpulse.llm.queries import op4

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ODD = ["", "\\", "\\\\", "\\l", "\\h\\c", "<#\\:", "### user: x </turn>\n", "a: b", "\\\\l<", None, "é😀#", "x" * 50_000]


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {
        conv: (
            "".join(f"{r}\n{x}\n" for _, _, r, x in sorted(turns)),
            "".join(x for _, _, r, x in sorted(turns) if r == "assistant"),
            len(turns),
        )
        for conv, turns in convs.items()
    }


def check(spark, frame, tmp_path, rows):
    folder = tmp_path / "sf"
    frame(rows, SCHEMA).write.mode("overwrite").parquet(str(folder / "conversations.parquet"))
    said = "\\### Assistant: </turn> ok"
    want = expected([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    got = {r.conv_id: r for r in op4(spark, str(folder)).collect()}
    assert set(got) == set(want)
    for conv, (told, loss, n) in want.items():
        row = got[conv]
        assert row.n_turns == n
        assert row.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars >= len(told)


def test_odd_texts_roles_and_nulls(spark, frame, tmp_path):
    roles = ["user", "assistant", "system", None, "a:b#<\\", ""]
    rows = [(i % 4 if i % 5 else None, i if i % 7 else None, roles[i % 6], ODD[i % len(ODD)]) for i in range(120)]
    check(spark, frame, tmp_path, rows + rows[:5])


def test_empty_table(spark, frame, tmp_path):
    check(spark, frame, tmp_path, [])


def test_one_long_conversation_in_blocks(spark, frame, tmp_path):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(1500)]
    check(spark, frame, tmp_path, rows)
    assert chat.format_blocks(frame(rows, SCHEMA)).count() == 6


def test_context_is_all_earlier_turns(frame):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t#{i}") for i in range(600)]
    blocks = chat.format_blocks(frame(rows, SCHEMA))
    found = chat.examples(blocks)
    assert found.count() == 300
    written = chat.example_texts(found, blocks).collect()
    turn = lambda r, t: f"### {r}: {t.replace('#', chr(92) + 'h')} </turn>\n"
    for row in written:
        assert row.context == "".join(turn(r, t) for _, i, r, t in rows if i < row.turn)
        assert row.target == turn("assistant", f"t#{row.turn}")


def test_losses_are_read_after_their_contexts(frame):
    rows = [(c, i, "assistant" if i % 3 else "user", f"é{i}" * (i % 4)) for c in (1, None) for i in range(300)]
    blocks = chat.format_blocks(frame(rows, SCHEMA)).cache()
    found = chat.examples(blocks).cache()
    texts = lambda df: sorted(r.loss_text for r in chat.read_losses(df, blocks).collect())
    want = sorted(t for _, _, r, t in rows if r == "assistant")
    assert texts(found) == want
    assert texts(found.selectExpr("* EXCEPT (context_chars)", "context_chars + 1 AS context_chars")) != want


def test_extra_columns_with_the_names_of_results(frame):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(6)]
    plain = frame(rows, SCHEMA)
    extra = plain.selectExpr("*", "'x' AS block", "'x' AS start", "'x' AS pieces", "'x' AS place", "'x' AS target", "'x' AS told")
    assert chat.examples(chat.format_blocks(extra)).collect() == chat.examples(chat.format_blocks(plain)).collect()


def test_rows_of_one_turn_number(spark, frame, tmp_path):
    rows = [(1, 5 if i % 2 else None, "assistant" if i % 3 else "user", f"t{i}") for i in range(700)]
    check(spark, frame, tmp_path, rows + rows[:50])
