"""Language identification with interpolated Kneser-Ney character models.

One model per language is fitted on a bounded sample of labelled documents: whole
documents in order of a hash of their id, at most ``sample_docs`` per language and
none beyond ``sample_chars`` characters; documents of more than a twentieth of these come last. A model is, for each order, a sorted array of
n-gram hashes with log-probabilities and a sorted array of context hashes with
back-off weights. A text belongs to the language whose model gives the least
cross-entropy per character.

A tenth of the sample is set aside to calibrate rejection: a text is rejected when its
cross-entropy is further above the mean of its language than ``REJECT`` deviations of
documents and of characters would explain, so short texts are given more room; one
nat per character is allowed in any case.
"""

from __future__ import annotations

import io
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import in_small_batches, kept_by_worker

ORDER = 5
UNDETERMINED = "und"
SAMPLE_DOCS, SAMPLE_CHARS, MOST_LANGUAGES = 2_000, 2_000_000, 1_000
REJECT, LEAST_ROOM = 12.0, 1.0
# Distinct letters that the models take to be possible, for those never seen.
ALPHABET = 4_096
# Characters scored at once, and remembered n-grams per worker.
CHUNK_CHARS = 1 << 19
CACHE_BITS = 20

_MULTIPLIERS = np.array(
    [pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(ORDER)], np.uint64
)  # one odd number per place, by a rule


@cache
def _letters() -> np.ndarray:
    """True for letters and the marks that combine with them, by code point."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters that are scored, of all texts, and where each text starts; the last number is the end.

    Lower case; each run of anything but letters is one blank, none leads. Each text
    is preceded by ``ORDER - 1`` zeros, which are not part of the numbers returned.
    """
    lower = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, lower), np.int64, len(lower))
    chars = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    starts = np.concatenate(([0], np.cumsum(lengths)))
    before = np.zeros(len(chars), bool)
    before[1:] = letter[:-1]
    before[starts[:-1][lengths > 0]] = False
    keep = letter | before
    kept = np.concatenate(([0], np.cumsum(keep)))[starts]
    sizes = np.diff(kept)
    places = np.arange(kept[-1]) + (ORDER - 1) * np.repeat(np.arange(1, len(texts) + 1), sizes)
    out = np.zeros(kept[-1] + (ORDER - 1) * len(texts), np.uint32)
    out[places] = np.where(letter, chars, np.uint32(32))[keep]
    return out, np.concatenate((kept[:-1] + (ORDER - 1) * np.arange(1, len(texts) + 1), [len(out)]))


def _hashes(columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of characters; the last column is the newest character."""
    n = columns.shape[1]
    with np.errstate(over="ignore"):
        total = np.full(len(columns), n, np.uint64)
        for i in range(n):
            total += (columns[:, n - 1 - i].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[i]
        return _mixed(total)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class CharacterModel:
    """``grams`` and ``contexts``: for each order from 1 on, sorted hashes and natural logarithms."""

    def __init__(self, grams, contexts):
        self.grams, self.contexts = grams, contexts

    @classmethod
    def fit(cls, texts: list[str]) -> CharacterModel:
        chars, starts = normalised(texts)
        inside = np.ones(len(chars), bool)
        for i in range(1, ORDER):
            inside[starts[:-1] - i] = False
        ends = np.flatnonzero(inside)
        windows = np.stack([chars[ends - (ORDER - 1) + i] for i in range(ORDER)], axis=1)
        # By order, from the highest: distinct windows, and how often (highest) or after how many characters they stand.
        levels, counts = [], None
        for n in range(ORDER, 0, -1):
            keys, first, seen = np.unique(_hashes(windows), return_index=True, return_counts=True)
            windows = windows[first]
            levels.append((keys, windows, seen.astype(np.float64)))
            windows = windows[:, 1:]
        grams, contexts = [], []
        lower_keys, lower = np.zeros(0, np.uint64), np.zeros(0)
        for n, (keys, rows, counts) in enumerate(reversed(levels), 1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.05
            above = _hashes(rows[:, :-1])
            context_keys, of, types = np.unique(above, return_inverse=True, return_counts=True)
            totals = np.bincount(of, weights=counts, minlength=len(types))
            backoff = discount * types / totals
            if n == 1:
                below = np.full(len(keys), 1 / ALPHABET)
            else:
                at, found = _find(lower_keys, _hashes(rows[:, 1:]))
                below = np.where(found, lower[at], 1 / ALPHABET)
            chance = (counts - discount) / totals[of] + backoff[of] * below
            grams.append((keys, np.log(chance)))
            contexts.append((context_keys, np.log(backoff)))
            lower_keys, lower = keys, chance
        return cls(grams, contexts)

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        """For each row, the log-probability of its last character after the others."""
        result = np.full(len(windows), -np.log(ALPHABET))
        for n in range(1, ORDER + 1):
            rows = windows[:, ORDER - n :]
            keys, values = self.grams[n - 1]
            context_keys, backoff = self.contexts[n - 1]
            at, seen = _find(context_keys, _hashes(rows[:, :-1]))
            result = result + np.where(seen, backoff[at] if len(backoff) else 0.0, 0.0)
            at, seen = _find(keys, _hashes(rows))
            result = np.where(seen, values[at] if len(values) else 0.0, result)
        return result

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {}
        for name, tables in (("g", self.grams), ("c", self.contexts)):
            for n, (keys, values) in enumerate(tables):
                arrays |= {f"{name}k{n}": keys, f"{name}v{n}": values.astype(np.float32)}
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CharacterModel:
        with np.load(io.BytesIO(data)) as read:
            return cls(*([(read[f"{x}k{n}"], read[f"{x}v{n}"]) for n in range(ORDER)] for x in "gc"))


class Scorer:
    """Cross-entropies of texts under several models. N-grams met before are remembered in a table of fixed size."""

    def __init__(self, models: list[CharacterModel]):
        self.models = models
        self.keys = np.zeros(1 << CACHE_BITS, np.uint64)
        self.values = np.zeros((1 << CACHE_BITS, len(models)), np.float32)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: scored characters, cross-entropy by model, and variance of a character's by model."""
        chars, starts = normalised(texts)
        sizes = np.diff(starts) - (ORDER - 1)
        sizes[-1] += ORDER - 1
        n_models = len(self.models)
        if not sizes.sum():
            return sizes, np.zeros((len(texts), n_models)), np.zeros((len(texts), n_models))
        places = np.arange(sizes.sum()) + (ORDER - 1) * np.repeat(np.arange(1, len(texts) + 1), sizes)
        with np.errstate(over="ignore"):
            total = np.full(len(places), ORDER, np.uint64)
            wide = chars.astype(np.uint64) + np.uint64(1)
            for i in range(ORDER):
                total += wide[places - i] * _MULTIPLIERS[i]
            keys = _mixed(total)
        slots = (keys >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        scores = self.values[slots]
        missed = np.flatnonzero(self.keys[slots] != keys)
        if len(missed):
            new, first, back = np.unique(keys[missed], return_index=True, return_inverse=True)
            ends = places[missed[first]]
            windows = np.stack([chars[ends - (ORDER - 1) + i] for i in range(ORDER)], axis=1)
            found = -np.stack([m.log_chances(windows) for m in self.models], axis=1).astype(np.float32)
            scores[missed] = found[back]
            at = (new >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            self.values[at], self.keys[at] = found, new
            # Of n-grams that share a slot, numpy keeps the last of each array; both were written in the same order.
        full = sizes > 0
        begins = (np.cumsum(sizes) - sizes)[full]
        mean, spread = (np.zeros((len(texts), n_models)) for _ in range(2))
        mean[full] = np.add.reduceat(scores, begins, axis=0, dtype=np.float64) / sizes[full, None]
        squares = np.add.reduceat(scores * scores, begins, axis=0, dtype=np.float64) / sizes[full, None]
        spread[full] = np.maximum(0.0, squares - mean[full] ** 2)
        return sizes, mean, spread


def text_chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Lists of about ``CHUNK_CHARS`` characters (one text may be longer), with the place of their first text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHUNK_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    """Fits one language. Every tenth document, if there are ten, calibrates instead."""
    rows = rows.sort_values(["place"])
    texts = rows["text"].tolist()
    aside = texts[9::10]
    fit_on = [t for i, t in enumerate(texts) if i % 10 != 9]
    model = CharacterModel.fit(fit_on)
    scorer = Scorer([model])
    found = [scorer.entropies(part) for _, part in text_chunks(aside or fit_on)]
    sizes, means, variances = (np.concatenate([f[i] for f in found]) for i in range(3))
    means, variances = means[sizes > 0, 0], variances[sizes > 0, 0]
    per_char = float(np.sqrt(variances.mean())) if len(means) else 0.0
    stats = (float(np.median(means)), float(means.std()), per_char) if len(means) else (0.0, 0.0, 0.0)
    return pd.DataFrame([[rows["lang"].iloc[0], model.to_bytes(), *stats]], columns=["lang", "model", "mean", "deviation", "per_char"])


def fit_models(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, most_languages: int = MOST_LANGUAGES,
) -> list:
    """One row per language: lang, model, mean, deviation, per_char; in order of lang.

    Rows without language or letters are left out. First the rows of each language are
    counted; then the share of hashes that holds about twice ``sample_docs`` of them is
    read, and the sample is taken from these. So neither what is shuffled, nor what one
    task fits, nor what reaches the driver grows with the documents. More than ``most_languages``
    different labels are an error: they would all go to the driver, and their models to all tasks.
    """
    told = docs.where(F.col(lang_col).isNotNull()).withColumn("_lang", F.col(lang_col).cast("string"))
    counted = told.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).limit(most_languages + 1)
    counts = {r["_lang"]: r["n"] for r in counted.collect()}
    if not counts:
        return []
    if len(counts) > most_languages:
        raise ValueError(f"there are more than {most_languages} languages")
    bound = {lang: int(2**63 * min(1.0, 2 * sample_docs / n)) - 1 for lang, n in counts.items()}
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 1)
    bounds = F.create_map(*(F.lit(x).cast(kind) for lang in bound for x, kind in ((lang, "string"), (bound[lang], "bigint"))))
    rows = told.select(
        F.col("_lang").alias("lang"), F.col(text_col).alias("text"), place.alias("place"), F.char_length(text_col).alias("n")
    )
    rows = rows.where((F.col("place") <= bounds[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
    # A text that would fill much of the sample is taken only when others leave room.
    is_long = F.col("n") > sample_chars // 20
    first = rows.withColumn("number", F.row_number().over(W.partitionBy("lang").orderBy(is_long, "place")))
    first = first.where(F.col("number") <= sample_docs)
    upto = W.partitionBy("lang").orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    sample = first.withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") <= sample_chars) | (F.col("number") == 1))
    schema = "lang string, model binary, mean double, deviation double, per_char double"
    return sorted(sample.groupBy("lang").applyInPandas(_fitted, schema).collect(), key=lambda r: r.lang)


class _Judge:
    """Scores batches of texts with a worker's models: language, score, cross-entropy and whether rejected."""

    def __init__(self, name: str, known: list[tuple]):
        def scorer() -> Scorer:
            return Scorer([CharacterModel.from_bytes(m) for _, m, *_ in known])

        self.scorer = kept_by_worker(("scorer", name), scorer) if known else None
        self.names = np.array([m[0] for m in known] or [UNDETERMINED], object)
        self.centre, self.deviation, self.per_char = (
            np.array([m[i] for m in known]) if known else np.zeros(1) for i in (2, 3, 4)
        )

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if self.scorer is None:
            sizes, entropy = np.zeros(len(texts)), np.zeros((len(texts), 1))
        else:
            sizes, entropy, _ = self.scorer.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        # As if the characters were independent, but of no more than 64, so close languages are told as close.
        apart = (entropy - least[:, None]) * np.minimum(sizes, 64)[:, None]
        score = np.where(sizes > 0, 1 / np.exp(-apart).sum(axis=1), 0.0)
        room = REJECT * (self.deviation[best] + self.per_char[best] / np.sqrt(np.maximum(sizes, 1)))
        rejected = (sizes == 0) | (least > self.centre[best] + np.maximum(room, LEAST_ROOM))
        return np.where(sizes > 0, self.names[best], UNDETERMINED), score, least, rejected


def _identified(shared):
    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(*shared.value)
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for first, part in text_chunks(texts):
                lang, score, entropy, rejected = judge.judge(part)
                columns = [
                    ids.slice(first, len(part)), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                    pa.array(entropy, pa.float64()), pa.array(rejected),
                ]
                yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return identified


def _shared(docs: DataFrame, models: list):
    in_small_batches(docs)
    # The name tells a worker that has read models already whether they are these.
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [tuple(m) for m in models]))


def identify(docs: DataFrame, models: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, cross_entropy, rejected.

    ``lang_pred`` is the language with the least cross-entropy (nats per character; of
    equals the first by name), or ``und`` for a text that is null or has no letter,
    whose score is 0. ``rejected`` is true for those and for texts unlike any language
    fitted. With no model at all, everything is ``und``. Whole texts are scored; null
    and repeated ids are kept and other columns ignored. The models, whose size the
    sample bounds, are the only broadcast.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        _identified(_shared(docs, models)), "doc_id bigint, lang_pred string, score double, cross_entropy double, rejected boolean"
    )


def without_rejected(docs: DataFrame, models: list, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that are not rejected. Nothing is shuffled.

    Without a model nothing is known to be unlike the languages, so all texts with a letter stay.
    """
    if not models:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    shared = _shared(docs, models)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(*shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            rejected = [judge.judge(part)[3] for _, part in text_chunks(texts)]
            yield batch.filter(pa.array(~np.concatenate(rejected) if rejected else [], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out(id_col: Column | str) -> Column:
    """Whether a document is kept from fitting: crc32 of its id as text leaves 2 when divided by 4."""
    text = F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2
