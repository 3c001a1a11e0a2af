"""Each stage of the pipeline against what its operator's definition asks for, on small tables."""

import os
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
from test_jaccard_join import expected as expected_components
from test_language import PlainJudge, made_texts
from tokenizers import Tokenizer

import corpus_pipeline
from eventpulse.llm.jaccard_join import FILTER_BITS, _with_key, one_of_each
from eventpulse.llm.mixing import mix, mixed
from eventpulse.llm.shingles import set_batches

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_copies", "decontaminate", "mix_sources", "token_files"]

    told = stages["language_id"](spark, docs, SF_DIR).cache()
    assert told.schema == docs.schema
    assert not rows_of(told) - rows_of(docs)
    assert told.count() >= docs.count() - 1

    single = stages["near_copies"](spark, told, SF_DIR).cache()
    groups = expected_components([(r.doc_id, r.text) for r in told.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, n, least in groups if i == least or not n)

    clean = stages["decontaminate"](spark, single, SF_DIR).cache()
    leaked = [r.doc_id for r in single.collect() if any(b in r.text for b in benchmark)]
    assert leaked
    assert sorted(r.doc_id for r in clean.collect()) == sorted({r.doc_id for r in single.collect()} - set(leaked))

    taken = stages["mix_sources"](spark, clean, SF_DIR).cache()
    assert taken.schema == docs.schema
    copies = {r.doc_id: r.copies for r in mix(clean).collect()}
    assert Counter(r.doc_id for r in taken.collect()) == Counter({i: n for i, n in copies.items() if n})

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at = 0
    texts = {r.doc_id: r.text for r in clean.collect()}
    for row in sorted(stages["token_files"](spark, taken, SF_DIR).collect(), key=lambda r: r.start):
        assert row.start == at
        assert row.n_tokens == len(tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids) + 1
        at += row.n_tokens


def test_language_stage_against_plain_models(spark, frame):
    rows = [(i, text, lang, f"s{i % 3}", i) for i, text, lang in made_texts(9, held_out_ids=True)]
    judge = PlainJudge({lang: [r[1] for r in rows if r[2] == lang] for lang in ("de", "en")})
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, frame(rows, SCHEMA), SF_DIR)
    assert rows_of(kept) == Counter(r for r in rows if not judge(r[1])[2])
    assert 20 < kept.count() < len(rows)


def test_token_stage_gives_added_tokens_their_ids(spark, frame):
    texts = ["plain", "a<|endoftext|>b", "<|endoftext|>", None, ""]
    rows = [(i, text, "en", "s0", 0) for i, text in enumerate(texts)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in dict(corpus_pipeline.STAGES)["token_files"](spark, frame(rows, SCHEMA), SF_DIR).collect()}
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


def odd_rows():
    dice = random.Random(11)
    base = [" ".join(f"w{dice.randrange(500)}" for _ in range(40)) for _ in range(12)]
    rows = [(i if i % 9 else None, base[i % 12] + (" x" if i % 5 else ""), "en", f"s{i % 3}" if i % 4 else None, i) for i in range(60)]
    return rows + [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, None, None, "s1", None), rows[1], rows[1]]


def test_one_of_each_group(frame):
    rows = odd_rows()
    docs = frame(rows, SCHEMA).selectExpr("*", "1 AS key", "'x' AS component")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    groups = expected_components([r[:2] for r in rows])
    want = Counter()
    for (doc_id, text), (_, n, least) in zip([r[:2] for r in rows], groups):
        if not n:
            want[doc_id, text] += 1
        elif doc_id == least:
            want[doc_id, text] = 1
    assert got == want


def test_groups_without_ids(frame):
    rows = [(None, "one two three four five six", "en", "s", 1)] * 3 + [(None, "another text", None, None, 1)]
    assert sorted(r.text for r in one_of_each(frame(rows, SCHEMA)).collect()) == ["another text", "one two three four five six"]


def wide_shuffles_of(df):
    plan, found = [df._jdf.queryExecution().executedPlan().initialPlan()], 0
    while plan:
        node = plan.pop()
        found += node.nodeName() == "Exchange" and node.output().size() >= len(df.columns)
        plan += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_documents_of_groups_are_shuffled_once(frame):
    assert wide_shuffles_of(one_of_each(frame(odd_rows(), SCHEMA))) == 1


def test_documents_alone_are_told_from_groups(frame):
    texts = ["one two three four five six", "another text", None, " ", "One two three four five six"]
    batch = pa.record_batch([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    keys = next(set_batches([batch]))[1]
    marked = np.zeros(1 << FILTER_BITS, bool)
    marked[[int(keys[0]) >> (64 - FILTER_BITS), 0]] = True
    shared = SimpleNamespace(value=np.packbits(marked).tobytes())

    def passed(in_groups):
        rows = _with_key(["doc_id", "text", "_set_key"], "text", shared, in_groups)([batch])
        return [r["doc_id"] for b in rows for r in b.to_pylist()]

    assert (passed(True), passed(False)) == ([0, 4], [1, 2, 3])


def test_mixed_repeats_whole_rows(frame, monkeypatch):
    rows = odd_rows()
    docs = frame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS hash", "3 AS copies", "4 AS target")
    by_row = Counter()
    for r in mix(docs).join(docs.select("doc_id").distinct(), "doc_id", "left_semi").collect():
        by_row[r.doc_id] += 1 if r["size"] == 0 else r.copies
    for most in (10_000, 0):  # both ways of dealing out the limits
        monkeypatch.setattr("eventpulse.llm.mixing.BROADCAST_SOURCES", most)
        out = mixed(docs)
        assert out.columns == docs.columns
        assert Counter(r.doc_id for r in out.collect() if r.doc_id is not None) == +by_row


def test_empty_documents(spark, frame):
    docs = frame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() == 0
        if name != "token_files":
            assert out.columns == docs.columns


def test_workers_of_all_stages_are_alike_and_give_memory_back(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    environment = spark.sparkContext.environment
    found = []
    for name, stage in corpus_pipeline.STAGES:
        if name != "mix_sources":  # has no Python workers
            for key in ("ARROW_DEFAULT_MEMORY_POOL", "MALLOC_MMAP_THRESHOLD_", "MALLOC_TRIM_THRESHOLD_"):
                environment.pop(key, None)
            stage(spark, docs, SF_DIR)
            found.append(dict(environment))

    def pools(batches):
        for _ in batches:
            yield pa.record_batch([[pa.default_memory_pool().backend_name], [os.environ["MALLOC_TRIM_THRESHOLD_"]]], names=["p", "t"])

    assert all(x == found[0] for x in found)
    assert {tuple(r) for r in spark.range(1).mapInArrow(pools, "p string, t string").collect()} == {("system", str(8 << 20))}
