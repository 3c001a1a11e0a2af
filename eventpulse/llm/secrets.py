"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's pattern a Boolean query of trigrams is derived that every match
must meet. The index holds a posting (trigram, document key) for each trigram of
these queries and each document whose lower-cased text has it; trigrams that no query
names are never looked up and get no postings. Postings are intersected per
document, which keeps a trigram that most documents have from becoming one large
group. Only documents left as candidates of a rule are searched with its pattern, and
only their texts are shuffled, to meet the numbers of their rules; a bitmap of the
candidates' keys, of fixed size, leaves all other texts where they are. A rule without
mandatory trigrams (such as a plain run of hex digits) searches all texts in place.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, text_or_empty, written
from .filters import key_filter, may_be_in

# Literal alternatives that are followed at once when a query is derived.
MOST_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and Python read alike; ``group`` must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed patterns of the base kinds, in this order.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# One of these sets of trigrams must be in the text.
AnyOf = frozenset[frozenset[str]]


def _any_of(literals: set[str]) -> list[AnyOf]:
    """The condition that one of the literals occurs; none if one of them is too short to have a trigram."""
    sets = {frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in literals}
    if frozenset() in sets:
        return []
    return [frozenset(s for s in sets if not any(other < s for other in sets))]


def _walk(parsed) -> tuple[set[str] | None, list[AnyOf]]:
    """The literals that the parsed pattern can match, if few, and conditions that any match meets."""
    literals, conditions = {""}, []

    def then(more: set[str]) -> None:
        nonlocal literals
        if len(literals) * len(more) > MOST_LITERALS:
            conditions.extend(_any_of(literals))
            literals = more
        else:
            literals = {a + b for a, b in itertools.product(literals, more)}

    whole = True

    def broken() -> None:
        nonlocal literals, whole
        conditions.extend(_any_of(literals))
        literals, whole = {""}, False

    for kind, value in parsed:
        if kind is sre.LITERAL:
            then({chr(value).lower()})
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            then({chr(c).lower() for _, c in value})
        elif kind is sre.SUBPATTERN or kind is sre.BRANCH:
            found = [_walk(x) for x in ([value[-1]] if kind is sre.SUBPATTERN else value[1])]
            if all(x is not None for x, _ in found):
                then(set().union(*(x for x, _ in found)))
            else:
                broken()
                if len(found) == 1:
                    conditions.extend(found[0][1])
        elif kind is sre.MAX_REPEAT:
            low, high, inner = value
            own, inside = _walk(inner)
            if own is not None and low == high == 1:
                then(own)
            elif own is not None and (low, high) == (0, 1):
                then(own | {""})
            else:
                if own is not None and low and len(own) == 1:
                    then({next(iter(own)) * min(low, 8)})
                broken()
                if low:
                    conditions.extend(inside)
        else:
            broken()
    if whole:
        return literals, conditions
    conditions.extend(_any_of(literals))
    return None, conditions


def trigram_query(pattern: str) -> list[AnyOf]:
    """Conditions on lower-cased trigrams, all of which a text with a match meets. Empty: search every text."""
    literals, conditions = _walk(sre_parser.parse(pattern))
    return conditions if literals is None else conditions + _any_of(literals)


def _trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for any_of in trigram_query(r.pattern) for s in any_of for t in s})


def trigram_index(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of a table of ``key`` and ``text``."""
    lowered = keyed.select("key", F.lower("text").alias("text"))
    has = [F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in trigrams]
    return lowered.select(F.explode(F.array_compact(F.array(*has))).alias("trigram"), "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Keys whose postings meet the queries: key, and ``rules``, the numbers of the rules to search."""
    numbers = {t: i for i, t in enumerate(_trigrams(rules))}
    words = len(numbers) // 62 + 1
    # Postings of a key are joined as bits, so the aggregate has fixed-size buffers and combines before the shuffle.
    place = F.element_at(F.create_map(*(F.lit(x) for t in numbers.items() for x in t)), F.col("trigram"))
    bits = index.withColumn("place", place).groupBy("key").agg(
        *(
            F.bit_or(F.when(F.col("place").between(62 * w, 62 * w + 61), F.expr(f"shiftleft(1L, place - {62 * w})")).otherwise(F.lit(0)))
            .alias(f"has{w}") for w in range(words)
        )
    )

    def all_in(trigrams: frozenset[str]) -> Column:
        masks = [sum(1 << numbers[t] - 62 * w for t in trigrams if numbers[t] // 62 == w) for w in range(words)]
        return functools.reduce(
            operator.and_, (F.col(f"has{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m)
        )

    def met(rule: Rule) -> Column | None:
        query = trigram_query(rule.pattern)
        every = [functools.reduce(operator.or_, map(all_in, sorted(any_of, key=sorted))) for any_of in query]
        return functools.reduce(operator.and_, every) if every else None

    found = [F.when(m, F.lit(i)) for i, m in enumerate(map(met, rules)) if m is not None]
    return bits.select("key", F.array_compact(F.array(*found)).alias("rules")).where(F.size("rules") > 0)


def _hits(rule: Rule, number: int) -> Column:
    """The rule's matches in order: rule, characters before it since the last match, its length, whether it counts."""
    pattern = F.lit(rule.pattern)
    matches = F.arrays_zip(
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("part"),
    )
    pieces = F.split("text", rule.pattern, -1)
    return F.zip_with(
        matches, F.slice(pieces, 1, F.size(matches)),
        lambda m, piece: F.struct(
            F.lit(number).alias("rule"), F.char_length(piece).cast("bigint").alias("gap"),
            F.char_length(m["match"]).cast("bigint").alias("length"), (F.char_length(m["part"]) >= rule.least).alias("counts"),
        ),
    )


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: doc_id, and ``spans``, an array of (start, rule, end, kind) in that order.

    Matches are leftmost and do not overlap within a rule; those whose group is too
    short are dropped after matching. Places are in code points, the end exclusive. A
    null text is empty, a null id is kept, repeated rows give repeated results, and a
    document without secrets has an empty array. Other columns are ignored.
    """
    text = text_or_empty(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    # Rows that agree in id and text share a key; what is found for one holds for all.
    keyed = rows.withColumn("key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), F.col("text")).cast("binary")))
    index = written(trigram_index(keyed.select("key", "text"), _trigrams(rules)), "trigram-index")
    chosen = written(candidates(index, rules), "secret-candidates")
    bitmap = key_filter(chosen)

    none_found = F.expr("CAST(array() AS array<struct<rule:int,gap:bigint,length:bigint,counts:boolean>>)")

    def search(number: int, rule: Rule) -> Column:
        if trigram_query(rule.pattern):
            wanted = F.array_contains("rules", F.lit(number))
        else:
            wanted = F.col("text").rlike(rule.pattern)
        return F.when(wanted, _hits(rule, number)).otherwise(none_found)

    maybe = keyed.where(may_be_in("key", bitmap)).join(chosen, "key", "left")
    rest = keyed.where(~may_be_in("key", bitmap))
    for_all = [(i, r) for i, r in enumerate(rules) if not trigram_query(r.pattern)]

    def hits(some: list[tuple[int, Rule]]) -> Column:
        return F.concat(none_found, *(search(i, r) for i, r in some)).alias("hits")

    found = maybe.select("doc_id", "key", hits(list(enumerate(rules))))
    searched = cut(found.unionByName(rest.select("doc_id", "key", hits(for_all))))
    hit = searched.where(F.size("hits") > 0).dropDuplicates(["key"]).select("key", F.posexplode("hits").alias("pos", "hit"))
    upto = W.partitionBy("key", "hit.rule").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("hit.gap") + F.col("hit.length")).over(upto)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    spans = (
        hit.withColumn("end", end)
        .where(F.col("hit.counts"))
        .select("key", F.struct(
            (F.col("end") - F.col("hit.length")).alias("start"), F.col("hit.rule").alias("rule"), "end",
            F.element_at(kinds, F.col("hit.rule") + 1).alias("kind"),
        ).alias("span"))
        .groupBy("key").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    none = F.expr("CAST(array() AS array<struct<start:bigint,rule:int,end:bigint,kind:string>>)")
    return searched.select("doc_id", "key").join(spans, "key", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def python_rules(rules: tuple[Rule, ...] = RULES) -> list[tuple[Rule, re.Pattern]]:
    """The rules compiled for Python, for tests; ASCII letters alone ignore case, as in Java."""
    return [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
