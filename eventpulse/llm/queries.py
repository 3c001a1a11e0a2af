"""The queries of this subpackage. Each applies one operator to its whole table."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, language, secrets
from .common import ORACLES, QUERIES, query, table, written  # noqa: F401
from .decontaminate import find_leaks
from .exact_dedup import exact_dedup
from .hard_negatives import mine_hard_negatives
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .licenses import LICENSE_TEXTS, TEMPLATES, LicenseRules, scan_licenses
from .line_dedup import dedup_lines
from .mixing import mix
from .periodic_runs import find_runs
from .token_files import read_documents, write_token_files

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_exact_dedup",
    f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256({LOWER}) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY {LOWER})
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = LicenseRules(templates=TEMPLATES + LICENSE_TEXTS, across_lines=True, telling=True)
    return scan_licenses(table(spark, sf_dir, "documents"), rules=rules)


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op4_chat_format")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    blocks = written(chat.format_blocks(told.unionByName(planted)), "chat")
    found = written(chat.examples(blocks), "chat-examples")

    turns = chat.read_turns(blocks).select(
        "conv_id", "block", "n_chars", F.size("turns").cast("bigint").alias("n"),
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("text"),
    )

    # The digests are of a whole conversation, so here, and only here, its blocks come together.
    def joined(*order: str) -> F.Column:
        return F.concat_ws("", F.sort_array(F.collect_list(F.struct(*order))).getField(order[-1]))

    formatted = turns.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sha2(joined("block", "text"), 256).alias("turns_sha256"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    losses = chat.read_losses(found, blocks).groupBy(F.col("conv_id").alias("of")).agg(
        F.sum(F.char_length("loss_text")).cast("bigint").alias("chars"), joined("block", "place", "loss_text").alias("text")
    )
    return formatted.join(losses, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.coalesce("chars", F.lit(0)).alias("loss_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op5_find_leaks")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole_words=True)


@query("op6_find_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secrets.BASE_RULES]
    of_base = F.filter("spans", lambda s: s["rule"] < len(base))

    def count(number: int) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == number)).cast("bigint")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(base)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_text(of_base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


@query(
    "op7_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             ('0x' || md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, ''))[1:13])::BIGINT AS hash
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn
      FROM d GROUP BY source),
    w AS (
      SELECT *, CASE rn % 3 WHEN 1 THEN 5e0 WHEN 2 THEN 2e0 ELSE 1e0 END AS weight, source_size * 3e0 AS most,
             sum(source_size) OVER ()::DOUBLE AS total
      FROM s),
    l AS (
      SELECT *, (total - coalesce(sum(most) OVER before, 0e0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0e0)) AS level
      FROM w WINDOW before AS (ORDER BY most / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM l),
    h AS (
      SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS upto
      FROM d GROUP BY source, hash),
    r AS (
      SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
             target - whole * source_size AS rest
      FROM t)
    SELECT d.doc_id, d.size, r.source_size, r.target,
           (d.size * least(3, r.whole + CASE WHEN h.upto <= r.rest OR (h.upto - h.words <= r.rest
             AND h.upto - r.rest < r.rest - (h.upto - h.words)) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
    JOIN h ON d.source IS NOT DISTINCT FROM h.source AND d.hash = h.hash
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    blocks = write_token_files(table(spark, sf_dir, "documents"), path, added_tokens=True)
    return read_documents(blocks)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language.fit_models(docs.where(~language.held_out("doc_id")))
    found = language.identify(docs, models)
    return found.withColumn("held_out", language.held_out("doc_id")).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"
    )


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every tenth document with words repeats, from word a on, a period of p of its words."""
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        numbers = [None if i is None else zlib.crc32(str(i).encode()) for i in ids]
        chosen, changed = [h is not None and h % 10 == 0 for h in numbers], []
        for i in np.flatnonzero(chosen).tolist():
            words, g = re.findall(rb"[^\x20\x09-\x0D]+", (texts[i].as_py() or "").encode()), numbers[i] // 10
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                words = (words[:a] + words[a : a + p] * (4 + g % 8))[: len(words)]
            changed.append(b" ".join(words).decode())
        texts = pc.replace_with_mask(texts, pa.array(chosen, pa.bool_()), pa.array(changed, texts.type))
        yield pa.record_batch([batch.column("doc_id"), texts], names=["doc_id", "text"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents as the contract of op11 changes them."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_planted, "doc_id bigint, text string")


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    start, length, period = -longest["col2"], longest["length"], -longest["col3"]
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_line_dedup",
    f"""
    WITH l AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    s AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE len(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.*, s.keep_id IS NOT NULL AND s.keep_id <> k.doc_id AS dropped FROM k LEFT JOIN s ON k.key = s.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op13_hard_negatives",
    """
    WITH e AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id AS other, list_inner_product(a.v, e.v)::BIGINT AS score
      FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
      SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT p.anchor_id, p.positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
           s.other AS negative_id, p.positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
    QUALIFY rank <= 10
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
