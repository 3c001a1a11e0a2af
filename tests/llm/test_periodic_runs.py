"""Periodic runs against a brute-force search for every period, and the contract's planted runs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from eventpulse.llm import periodic_runs
from eventpulse.llm.periodic_runs import find_fragments, find_runs, tiles_of
from eventpulse.llm.queries import op11

SCHEMA = "doc_id bigint, text string"


def plain_runs(words):
    """All (start, period, length), by comparing the words with themselves at every distance."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        start = 0
        while start < n - q:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            block = words[start : start + q]
            smaller = any(all(block[i] == block[i + d] for i in range(q - d)) for d in range(1, q) if q % d == 0)
            if length >= max(12, 2 * q) and not smaller:
                found.append((start, q, length))
            start = end
    return sorted(found)


def collapsed(words, runs):
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def made_text(dice):
    parts = []
    for _ in range(dice.randint(0, 5)):
        words = [dice.choice("abcdé") for _ in range(dice.choice([1, 2, 3, 4, 5, 6, 7, 8, 12, 16, 31, 64]))]
        repeats = dice.choice([1, 1, 2, 3, 5, 9])
        parts += words * repeats + words[: dice.randint(0, len(words))]
    return "".join(w + dice.choice([" ", "\n", "\t ", "  "]) for w in parts)


@pytest.mark.parametrize("tile", [64, 128, 8192])
def test_against_plain_search(frame, tile):
    dice = random.Random(tile)
    texts = [None, "", " \n\t", "a", "a " * 11, "a " * 12, "a b " * 500, "x " * 3000, *(made_text(dice) for _ in range(150))]
    rows = [(i % 140 if i % 13 else None, t) for i, t in enumerate(texts)] + [(3, texts[6])] * 5
    docs = frame(rows, SCHEMA).selectExpr("*", "1 AS runs", "2 AS `key`", "'x' AS of", "3 AS `start`", "4 AS words")
    # A low bound on long texts sends the tiles of some of them to other tasks.
    got = find_runs(docs, tile=tile, long_chars=400).collect()
    want = []
    for doc_id, text in rows:
        words = words_of(text)
        runs = plain_runs(words)
        want.append((doc_id if doc_id is not None else -1, runs, len(words), collapsed(words, runs)))
    found = [(r.doc_id if r.doc_id is not None else -1, [tuple(x) for x in r.runs], r.n_words, r.collapsed) for r in got]
    assert sorted(found) == sorted(want)
    assert any(len(x[1]) > 3 for x in want)


def test_empty_table(frame):
    assert find_runs(frame([], SCHEMA)).collect() == []


def test_tiles_share_twice_their_longest_period():
    for n in (12, 63, 64, 65, 100, 127, 1000, 5000):
        covered = set()
        by_scale = {}
        for low, high, start, end in tiles_of(n, 64):
            by_scale.setdefault((low, high), []).append((start, end))
            covered |= set(range(low, high))
        assert covered >= set(range(1, n // 2 + 1))
        for (low, high), tiles in by_scale.items():
            assert tiles[0][0] == 0 and tiles[-1][1] == n
            assert all(a[1] - b[0] >= max(2 * (high - 1), 12) for a, b in zip(tiles, tiles[1:]))


def test_a_very_long_text_of_one_word_and_of_long_periods():
    one = np.zeros(100_000, np.int32)
    tile, period, start, end = find_fragments([one], np.array([1]), np.array([50_000]))
    assert list(zip(period, start, end)) == [(1, 0, 100_000)]
    dice = np.random.default_rng(5)
    block = dice.integers(0, 1_000_000, 30_011, dtype=np.int32)
    words = np.concatenate((dice.integers(0, 1_000_000, 777, dtype=np.int32), block, block, block[:500]))
    tile, period, start, end = find_fragments([words, words[:100]], np.array([1, 1]), np.array([50_000, 50]))
    assert list(zip(tile, period, start, end)) == [(0, 30_011, 777, 777 + 2 * 30_011 + 500)]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_against_the_contract(spark, frame, tmp_path):
    dice = random.Random(8)
    rows = [(i * 7919, made_text(dice) if i % 3 else " ".join(f"w{dice.randint(0, 400)}" for _ in range(dice.randint(0, 300)))) for i in range(260)]
    rows += [(None, "a b " * 9), (5, None), (-7, "c " * 30)]
    folder = tmp_path / "sf"
    frame(rows, SCHEMA).selectExpr("*", "1 AS g", "'y' AS words").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in op11(spark, str(folder)).collect()}
    assert len(got) == len(rows)
    n_planted = 0
    for doc_id, text in rows:
        before = words_of(text)
        words = before if doc_id is None else planted(doc_id, before)
        n_planted += words != before
        runs = plain_runs(words)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[2], x[0], x[1]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.period, r.length) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[2] // best[1] if runs else None)
        listed = "".join(f"{a},{n},{q}\n" for a, q, n in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert n_planted > 5


def test_tile_size_is_checked(frame):
    with pytest.raises(ValueError):
        find_runs(frame([], SCHEMA), tile=100)
    assert periodic_runs.TILE >= 64
