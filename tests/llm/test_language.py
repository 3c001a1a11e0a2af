"""Language models against a plain Kneser-Ney, and identification by held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventpulse.llm import language
from eventpulse.llm.language import ORDER, CharacterModel, Scorer, fit_models, identify, normalised, without_rejected
from eventpulse.llm.queries import op9

SF_DIR = "/root/testdata/sf0.01"


def plain_words(text):
    out = []
    for c in text.lower():
        if language._letters()[ord(c)]:
            out.append(c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


class PlainModel:
    """Interpolated Kneser-Ney, written out with dictionaries."""

    def __init__(self, texts):
        counts = [None] + [Counter() for _ in range(ORDER)]
        for text in texts:
            padded = "\0" * (ORDER - 1) + plain_words(text)
            for i in range(ORDER - 1, len(padded)):
                counts[ORDER][padded[i - ORDER + 1 : i + 1]] += 1
        for n in range(ORDER - 1, 0, -1):
            for gram in counts[n + 1]:
                counts[n][gram[1:]] += 1
        self.counts, self.discounts = counts, [0.0]
        self.totals, self.types = defaultdict(int), defaultdict(int)
        for n in range(1, ORDER + 1):
            ones, twos = (sum(c == k for c in counts[n].values()) for k in (1, 2))
            self.discounts.append(min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.05)
            for gram, c in counts[n].items():
                self.totals[n, gram[:-1]] += c
                self.types[n, gram[:-1]] += 1

    def chance(self, gram):
        if not gram:
            return 1 / language.ALPHABET
        n, lower = len(gram), self.chance(gram[1:])
        total = self.totals.get((n, gram[:-1]), 0)
        if not total:
            return lower
        d = self.discounts[n]
        return max(self.counts[n][gram] - d, 0) / total + d * self.types[n, gram[:-1]] / total * lower

    def terms(self, text):
        padded = "\0" * (ORDER - 1) + plain_words(text)
        return [-math.log(self.chance(padded[i - ORDER + 1 : i + 1])) for i in range(ORDER - 1, len(padded))]

    def entropy(self, text):
        terms = self.terms(text)
        return sum(terms) / len(terms) if terms else 0.0


class PlainJudge:
    """Decides by plain models of fewer than ten texts a language, which calibrate themselves."""

    def __init__(self, texts_of):
        self.of = {}
        for lang, texts in sorted(texts_of.items()):
            model = PlainModel(texts)
            found = [np.array(model.terms(t)) for t in texts]
            means = [t.mean() for t in found]
            self.of[lang] = model, np.median(means), np.std(means), math.sqrt(np.mean([t.var() for t in found]))

    def __call__(self, text):
        """Language, cross-entropy and whether rejected."""
        size = len(plain_words(text or ""))
        if not size:
            return "und", 0.0, True
        entropy, lang = min((model.entropy(text), lang) for lang, (model, *_) in self.of.items())
        _, centre, deviation, per_char = self.of[lang]
        room = max(language.REJECT * (deviation + per_char / math.sqrt(size)), language.LEAST_ROOM)
        return lang, entropy, bool(entropy > centre + room)


def made_texts(seed, held_out_ids):
    """Rows (doc_id, text, lang): nine labelled documents of two languages, others of both, odd ones, and noise."""
    dice = random.Random(seed)
    words = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split()}
    made = lambda lang: " ".join("".join(dice.choices(words[lang], k=2)) for _ in range(60))
    aside = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    fitted = [i for i in range(400) if i not in set(aside)]
    rows = [(fitted[2 * i + j], made(lang), lang) for i in range(9) for j, lang in enumerate(words)]
    noise = ["".join(chr(dice.randrange(0x4E00, 0x9000)) for _ in range(300)), "qxzj vwk " * 50, "xqz"]
    others = [made(lang) for lang in words for _ in range(12)] + [made("en") + made("de")] * 2
    odd = [None, "", "12 34 !", "der", "Tion? " * 3, (made("en") + " ") * 40]
    # Without a label a document takes no part in fitting wherever it is.
    ids = aside if held_out_ids else range(1000, 2000)
    return rows + [(i, text, None) for i, text in zip(ids, others + noise + odd)]


def test_model_equals_the_plain_one():
    dice = random.Random(4)
    word = lambda: "".join(dice.choices("abcdé ", k=dice.randint(1, 7)))
    texts = [" ".join(word() for _ in range(dice.randint(0, 30))) for _ in range(25)] + ["", "İx 12--y", "Z"]
    model = CharacterModel.from_bytes(CharacterModel.fit(texts).to_bytes())
    plain = PlainModel(texts)
    probes = [" ".join(word() for _ in range(dice.randint(0, 10))) for _ in range(40)] + ["", "??", "qqq zz", "日本", "x" * 5000]
    scorer = Scorer([model, model])
    for _ in range(2):  # the second time from the table of n-grams met before
        sizes, entropies, _ = scorer.entropies(probes)
        for text, size, found in zip(probes, sizes, entropies):
            assert size == len(plain_words(text))
            assert np.allclose(found, plain.entropy(text), atol=2e-4)


def test_decisions_equal_the_plain_ones(frame):
    rows = made_texts(8, held_out_ids=False)
    judge = PlainJudge({lang: [t for _, t, own in rows if own == lang] for lang in ("de", "en")})
    schema = "doc_id bigint, text string, lang string"
    got = {r.doc_id: r for r in identify(frame(rows, schema), fit_models(frame(rows, schema))).collect()}
    assert sorted(got) == sorted(i for i, *_ in rows)
    rejected = 0
    for doc_id, text, _ in rows:
        lang, entropy, is_rejected = judge(text)
        found = got[doc_id]
        assert (found.lang_pred, found.rejected) == (lang, is_rejected), text
        assert abs(found.cross_entropy - entropy) < 2e-4 or lang == "und"
        rejected += is_rejected
    assert 5 <= rejected < len(rows) // 2


def test_chances_of_a_context_add_up_to_one():
    plain = PlainModel(["abab abc", "bca"])
    model = CharacterModel.fit(["abab abc", "bca"])
    letters = "abc "
    rest = (language.ALPHABET - len(letters)) * math.exp(model.log_chances(np.array([[0, 0, 0, 97, 99_999]]))[0])
    rows = np.array([[0, 0, 0, 97, ord(c)] for c in letters])
    assert abs(np.exp(model.log_chances(rows)).sum() + rest - 1) < 1e-9
    assert abs(sum(plain.chance("\0\0\0a" + c) for c in letters) - np.exp(model.log_chances(rows)).sum()) < 1e-9


def test_normalised_texts():
    chars, starts = normalised(["  Ab, c!", "", "12", "é-é"])
    parts = ["".join(map(chr, chars[a : b - (ORDER - 1) if i < 3 else b])) for i, (a, b) in enumerate(zip(starts, starts[1:]))]
    assert parts == ["ab c ", "", "", "é é"]


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = op9(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    aside = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in aside) >= 0.98 * len(aside)
    assert sum(r.rejected for r in got) <= 0.002 * len(got)


def test_rejection_nulls_repeats_and_clashing_names(spark, frame):
    dice = random.Random(5)
    words = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split()}
    made = lambda lang: " ".join("".join(dice.choices(words[lang], k=2)) for _ in range(60))
    rows = [(i, made(lang), lang) for i in range(200) for lang in words]
    schema = "doc_id bigint, text string, lang string"
    noise = "".join(chr(dice.randrange(0x4E00, 0x9000)) for _ in range(300))
    odd = [(900, None, "en"), (901, "", None), (902, "12 34 !", "xx"), (903, noise, None), (904, made("de"), None), (904, made("de"), None)]
    odd += [(None, made("en"), None), (905, (made("en") + " ") * 1000, None)]
    models = fit_models(frame(rows + odd, schema))
    assert [m.lang for m in models] == ["de", "en"]
    docs = frame(odd, schema).selectExpr("*", "'q' AS lang_pred", "2 AS score")
    got = {(r.doc_id, r.lang_pred, r.rejected) for r in identify(docs, models).collect()}
    assert got == {
        (900, "und", True), (901, "und", True), (902, "und", True), (903, "en", True),
        (904, "de", False), (None, "en", False), (905, "en", False),
    }
    assert identify(docs, models).count() == len(odd)


def test_empty_tables(frame):
    schema = "doc_id bigint, text string, lang string"
    assert fit_models(frame([], schema)) == []
    assert [r.lang_pred for r in identify(frame([(1, "word", None)], schema), []).collect()] == ["und"]
    assert identify(frame([], schema), []).collect() == []


def test_sample_is_bounded(frame):
    rows = [(i, f"word {i}", "en") for i in range(300)]
    ((lang, _, *_),) = fit_models(frame(rows, "doc_id bigint, text string, lang string"), sample_docs=10, sample_chars=40)
    assert lang == "en"


def test_long_documents_leave_a_sample(frame):
    """Texts that would fill the sample come last; where there are no others, one is taken."""
    words = {"en": "the quick brown fox jumps over the lazy dog", "de": "der schnelle braune fuchs springt weit hinaus"}
    rows = [(i, f"{words['en']} {i}", "en") for i in range(30)] + [(100 + i, (words["en"] + " ") * 300, "en") for i in range(30)]
    rows += [(200 + i, (words["de"] + f" {i} ") * 300, "de") for i in range(5)]
    docs = frame(rows, "doc_id bigint, text string, lang string")
    models = fit_models(docs, sample_chars=20_000)
    assert [m.lang for m in models] == ["de", "en"]
    got = {r.doc_id: r.lang_pred for r in identify(docs, models).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    with pytest.raises(ValueError, match="languages"):
        fit_models(docs, most_languages=1)


def test_without_a_model_texts_with_a_letter_stay(frame):
    docs = frame([(1, "some text", None), (2, None, None), (3, "123 !", None), (4, "ß", None)], "doc_id bigint, text string, lang string")
    assert fit_models(docs) == []
    assert sorted(r.doc_id for r in without_rejected(docs, []).collect()) == [1, 4]
