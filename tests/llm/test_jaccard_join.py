"""The Jaccard join against all pairs, the prefix tree against plain sets, and components against a search."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from eventpulse.llm import jaccard_join
from eventpulse.llm.components import components
from eventpulse.llm.jaccard_join import _SEVERAL, _counted, _packed, _range_runs, jaccard_components
from eventpulse.llm.prefix_tree import PrefixTree

SCHEMA = "doc_id bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(rows)]


def near_copies(dice, n, length, vocabulary=400, edits=3):
    base = [f"w{dice.randrange(vocabulary)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(dice.randint(0, edits)):
            at = dice.randrange(len(words))
            words[at : at + dice.randint(0, 2)] = [f"w{dice.randrange(vocabulary)}"]
        out.append(" ".join(words))
    return out


def check(frame, rows):
    got = jaccard_components(frame(rows, SCHEMA, parts=5).selectExpr("*", "1 AS key", "2 AS n", "3 AS component_id"))
    order = lambda t: tuple((x is not None, x or 0) for x in t)
    have = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=order)
    assert have == sorted(expected(rows), key=order)


def generated(dice):
    texts = []
    for length in (1, 3, 4, 5, 6, 8, 12, 20, 40, 60, 90, 150):
        texts += near_copies(dice, 12, length)
    passage = near_copies(dice, 1, 60)[0]
    texts += [passage + " " + t for t in near_copies(dice, 25, 18, vocabulary=10_000, edits=9)]
    texts += [t.upper() for t in texts[::9]] + texts[::7]
    dice.shuffle(texts)
    return texts


def test_against_all_pairs(frame):
    dice = random.Random(7)
    rows = [(i * 3 if i % 17 else None, t) for i, t in enumerate(generated(dice))]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a"), (5004, "A"), (5005, "word " * 30_000), rows[1], rows[1]]
    check(frame, rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_in_blocks(frame, monkeypatch, seed):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(jaccard_join, "RANGE_SHINGLES", 900)
    dice = random.Random(seed)
    texts = near_copies(dice, 90, 70, edits=14) + generated(dice)
    check(frame, [(i, t) for i, t in enumerate(texts)])


def test_empty_tables(frame):
    assert jaccard_components(frame([], SCHEMA)).collect() == []
    check(frame, [(1, None), (2, "")])
    check(frame, [(1, "one two three four five six")])


def test_prefix_tree():
    dice = random.Random(8)
    for _ in range(150):
        top = dice.choice([6, 12, 40])
        base = [set(dice.sample(range(top), dice.randint(1, top))) for _ in range(3)]
        sets = [sorted(dice.choice(base) ^ set(dice.choices(range(top), k=dice.randint(0, 3)))) for _ in range(dice.randint(1, 25))]
        sizes = np.array([max(1, len(s) + dice.choice([0, 0, 1, 2])) for s in sets])
        tree, marked = PrefixTree([np.array(s, np.int64) for s in sets], sizes), np.zeros(top, bool)
        for own, size in zip(sets, sizes.tolist()):
            common = [len(set(own) & set(s)) for s in sets]
            want = [j for j, c in enumerate(common) if 100 * c >= 75 * (size + int(sizes[j]) - c)]
            assert sorted(tree.probe(np.array(own, np.int64), size, marked).tolist()) == want
            assert not marked.any()


def test_components(spark):
    dice = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, dice.randrange(101, 160)) for _ in range(60)]
    edges += [(dice.randrange(200, 400), dice.randrange(200, 400)) for _ in range(120)] + [(7, 7), (500, 500)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    least = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == least
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("most", [7, None])
def test_every_link_is_counted(frame, monkeypatch, most):
    if most:
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", most)
    dice = random.Random(4)
    texts = near_copies(dice, 50, 70, edits=6) + near_copies(dice, 30, 25, edits=2) + generated(dice)[:150] + ["", "a"]
    got = {r.doc_id: r.n_links for r in jaccard_components(frame(list(enumerate(texts)), SCHEMA)).collect()}
    sets = {shingles(t) for t in texts} - {frozenset()}
    for i, text in enumerate(texts):
        own = shingles(text)
        want = sum(100 * len(own & s) >= 75 * len(own | s) for s in sets if s != own) if own else 0
        assert got[i] == want
    assert max(got.values()) > 10


def test_rows_of_ranges_carry_only_their_own_classes():
    """What the runs send grows with the shingles, not with classes times ranges."""
    texts = near_copies(random.Random(12), 400, 40, vocabulary=100_000, edits=40)
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sent = {}
    for n_ranges in (4, 4_000):
        rows = [r for b in _range_runs(30, n_ranges)(iter([batch])) for r in b.to_pylist()]
        sent[n_ranges] = sum(len(r["keys"]) // 8 for r in rows)
    assert sent[4_000] <= sum(len(shingles(t)) for t in texts)
    assert sent[4] <= 4 * len(texts)


def test_chained_sets_meet_few_blocks(frame, monkeypatch):
    """Windows that slide along one long text are one group, but far ones are not compared, and no link is lost."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 10)
    dice = random.Random(13)
    words = near_copies(dice, 1, 1300, vocabulary=100_000, edits=0)[0].split()
    texts = [" ".join(words[i : i + 60]) for i in range(0, 1200, 4)]
    seen = []
    plain = jaccard_join._meets

    def counted(blocked):
        found = plain(blocked)
        seen.append((blocked.count(), blocked.select("candidate", "block").distinct().count(), found.count()))
        return found

    monkeypatch.setattr(jaccard_join, "_meets", counted)
    check(frame, list(enumerate(texts)))
    [(n_sets, n_blocks, n_meets)] = seen
    assert n_sets > 250 and n_blocks > 20
    assert n_meets < n_sets * n_blocks / 3


def test_hot_shingles_in_blocks(frame, monkeypatch):
    """A passage that most texts share, in a group of many blocks of one home."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 9)
    dice = random.Random(14)
    passage = near_copies(dice, 1, 50)[0]
    texts = [passage + " " + t for t in near_copies(dice, 70, 14, vocabulary=10_000, edits=8)]
    texts += [passage + " " + near_copies(dice, 1, dice.randint(1, 60), vocabulary=10_000)[0] for _ in range(60)]
    check(frame, list(enumerate(texts)))


def packed_range(n_runs, n_hashes, n_keys, n_values):
    """Runs of one range of hashes as ``_range_runs`` writes them, and the shared shingles of each class by plain counting."""
    random_of, rows, holders, expected_counts = np.random.default_rng(5), [], {}, Counter()
    for run in range(n_runs):
        values = np.unique(random_of.integers(1 << 33, (1 << 33) + n_values, n_hashes, np.uint64))
        # Some classes are in several runs.
        keys = np.arange(1, n_keys + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(run // 2)
        alone = random_of.integers(0, n_keys, len(values)).astype(np.uint32)
        alone[random_of.random(len(values)) < 0.05] = _SEVERAL
        several = random_of.integers(0, 3, n_keys).astype(np.uint32)
        rows.append((0, _packed(np.diff(values, prepend=np.uint64(0))), _packed(alone), keys.tobytes(), _packed(several)))
        if n_runs * n_hashes <= 100_000:
            for key, n in zip(keys.tolist(), several.tolist()):
                expected_counts[key] += n
            for value, at in zip(values.tolist(), alone.tolist()):
                holders.setdefault(value, []).append(None if at == _SEVERAL else int(keys[at]))
    for found in holders.values():
        if len(set(found)) > 1 or None in found:
            for key in found:
                if key is not None:
                    expected_counts[key] += 1
    return pd.DataFrame(rows, columns=["range", "hashes", "holders", "keys", "several"]), +expected_counts


@pytest.mark.parametrize("n_values", [1, 3, 700, 30_000])
def test_counts_of_a_range_against_plain_counting(n_values):
    rows, plain = packed_range(9, 3_000, 40, n_values)
    got = Counter()
    for row in _counted(4)(rows).itertuples():
        keys, counts = np.frombuffer(row.keys, np.uint64).tolist(), np.frombuffer(row.counts, np.int32).tolist()
        assert {k % 4 for k in keys} == {row.bucket} and not got.keys() & set(keys)
        got.update(dict(zip(keys, counts)))
    assert got == plain


def test_a_range_is_counted_in_little_memory():
    rows, _ = packed_range(40, 50_000, 5_000, 1 << 22)
    tracemalloc.start()
    _counted(4)(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The hash and the holder of a shingle take 16 bytes; all else together, no more than these.
    assert peak < 2 * 16 * 40 * 50_000
