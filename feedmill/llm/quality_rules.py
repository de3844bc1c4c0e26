"""Quality rules as weak supervision, in built-in functions only.

Each rule looks at one count of a text and votes *good*, votes *bad* or abstains.
Nobody tells how far a rule can be trusted: expectation-maximisation estimates,
from how the votes of all documents fall together, how often a good and a bad
document get each vote. A document's verdict is its posterior probability of
being good under these accuracies, so one broken rule does not throw a document
out as an all-must-pass filter would.

Only the histogram of vote patterns reaches the driver: at most ``3 ** rules``
rows, whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bind, land

WINDOW = 8
#: Words of a block in which distinct words are counted.
BLOCK = 1000
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLD = 0.5
ROUNDS = 60
#: Weight of the starting belief against the documents, and its share of good documents.
PRIOR_SHARE = 0.1
START_GOOD = 0.8

GOOD, BAD, ABSTAIN = 1, 0, -1


def _repeat_words(words: Column) -> Column:
    """How many words stand in an 8-word window that occurs twice or more.

    Windows are compared by 64-bit hash. Sorting (hash, place) puts equal windows
    side by side; the words covered are then the gaps between their places, at
    most one window wide.
    """

    def covered(places: Column) -> Column:
        reach = F.transform(
            places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(reach, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def places(ranked: Column) -> Column:
        twins = F.filter(
            ranked,
            lambda x, i: F.coalesce(F.get(ranked, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twins, lambda x: x["p"]))

    def count(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            bind(bind(ranked, places), covered)
        )

    def windows(hashed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, bind(bind(hashed, windows), count)).otherwise(F.lit(0).cast("bigint"))


def _distinct_in_blocks(words: Column) -> Column:
    """Distinct words of each block of ``BLOCK`` words, added up. Unlike those of the whole text, their share
    does not fall with its length."""
    starts = F.sequence(F.lit(1), F.size(words), F.lit(BLOCK))
    each = F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(words, i, BLOCK))))
    total = F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.size(words) > BLOCK, total).otherwise(F.size(F.array_distinct(words)).cast("bigint"))


def counts(text: Column) -> Column:
    """The base counts of a text as one struct. A null text has no words and no lines."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        words = F.array_remove(F.split(F.translate(t, SPACES, " " * len(SPACES)), " "), "")
        blank = " " + SPACES
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)

        def with_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.translate(t, blank, "")).cast("bigint").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
                bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
                _repeat_words(w).alias("n_repeat_words"),
                bind(lines, lambda x: F.size(x)).cast("bigint").alias("n_lines"),
                F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
                F.length(F.regexp_replace(t, r"[^\p{L}\p{M}]+", "")).cast("bigint").alias("n_letters"),
                (F.length(t) - F.length(F.translate(t, ".!?", ""))).cast("bigint").alias("n_stops"),
                _distinct_in_blocks(w).alias("n_distinct_words"),
            )

        return bind(words, with_words)

    return bind(text, of)


def votes(c: Column) -> dict[str, Column]:
    """One vote per rule from the struct of :func:`counts`. A text without words gets *bad* for length, and no other vote."""
    words = c["n_words"]
    some = words > 0

    def rule(bad: Column, good: Column) -> Column:
        return F.when(some & bad, BAD).when(some & good, GOOD).otherwise(ABSTAIN).cast("int")

    return {
        "v_length": F.when(words < MIN_WORDS, BAD).when(words >= 40, GOOD).otherwise(ABSTAIN).cast("int"),
        "v_word_size": rule(
            (c["word_chars"] < 2.5 * words) | (c["word_chars"] > 12 * words),
            (c["word_chars"] >= 3.5 * words) & (c["word_chars"] <= 9 * words),
        ),
        "v_symbols": rule(c["n_symbols"] > 0.1 * words, c["n_symbols"] <= 0.02 * words),
        "v_letters": rule(c["n_letters"] < 0.9 * c["word_chars"], c["n_letters"] >= 0.94 * c["word_chars"]),
        "v_dup_lines": rule(
            c["n_dup_lines"] > 0.3 * c["n_lines"], (c["n_dup_lines"] == 0) & (c["n_lines"] > 1)
        ),
        "v_repeats": rule(c["n_repeat_words"] > 0.2 * words, c["n_repeat_words"] <= 0.05 * words),
        "v_case": rule(c["n_upper"] > 0.25 * c["word_chars"], c["n_upper"] <= 0.08 * c["word_chars"]),
        "v_stops": rule(
            (c["n_stops"] > 0.5 * words) | ((c["n_stops"] * 60 < words) & (words >= 40)),
            (c["n_stops"] * 30 >= words) & (c["n_stops"] <= 0.25 * words),
        ),
        "v_variety": rule(c["n_distinct_words"] < 0.15 * words, c["n_distinct_words"] > 0.35 * words),
    }


RULES = ("v_length", "v_word_size", "v_symbols", "v_letters", "v_dup_lines", "v_repeats", "v_case", "v_stops", "v_variety")


@dataclass(frozen=True)
class Model:
    """``odds[rule][vote]``: log of P(vote | good) / P(vote | bad); ``prior``: log odds of good."""

    prior: float
    odds: dict[str, dict[int, float]]


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> Model:
    """EM over (votes, number of documents); an abstention is no evidence.

    A document that is bad need break one rule only, so the starting belief gives
    a bad document a bad vote from few rules, and a good document from hardly
    any. The belief stays in as a prior worth ``PRIOR_SHARE`` of the documents:
    it tells the two classes apart, which the votes alone cannot. With no
    documents it is the answer.
    """
    start = {GOOD: 0.01, BAD: 0.2}
    weight = 1 + PRIOR_SHARE * sum(n for _, n in patterns)
    share = START_GOOD
    belief = {c: [p] * len(RULES) for c, p in start.items()}

    def odds(r: int, v: int) -> float:
        if v == ABSTAIN:
            return 0.0
        good, bad = belief[GOOD][r], belief[BAD][r]
        return math.log(good / bad) if v == BAD else math.log((1 - good) / (1 - bad))

    for _ in range(ROUNDS):
        given = {c: [weight] * len(RULES) for c in start}
        against = {c: [weight * p] * len(RULES) for c, p in start.items()}
        mass = {GOOD: weight * START_GOOD, BAD: weight * (1 - START_GOOD)}
        for pattern, n in patterns:
            logit = math.log(share / (1 - share)) + sum(odds(r, v) for r, v in enumerate(pattern))
            good = 1 / (1 + math.exp(-max(-700, min(700, logit))))
            for c, p in ((GOOD, good), (BAD, 1 - good)):
                mass[c] += n * p
                for r, v in enumerate(pattern):
                    if v != ABSTAIN:
                        given[c][r] += n * p
                        against[c][r] += n * p * (v == BAD)
        share = mass[GOOD] / (mass[GOOD] + mass[BAD])
        belief = {c: [a / g for a, g in zip(against[c], given[c])] for c in start}
    return Model(
        math.log(share / (1 - share)),
        {name: {v: odds(r, v) for v in (GOOD, BAD)} for r, name in enumerate(RULES)},
    )


def fit(voted: DataFrame) -> Model:
    """Accuracies from the vote columns of all rows."""
    seen = voted.groupBy(*RULES).count().collect()
    return estimate([(tuple(r[name] for name in RULES), r["count"]) for r in seen])


def posterior(model: Model) -> Column:
    logit = F.lit(model.prior)
    for name, of in model.odds.items():
        logit = logit + F.when(F.col(name) == GOOD, of[GOOD]).when(F.col(name) == BAD, of[BAD]).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def voted(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the input row, or its columns ``carry``), ``c`` (counts) and one per vote."""
    row = F.struct(*[F.col(f"`{x}`") for x in (docs.columns if carry is None else carry)])
    rows = docs.select(row.alias("row"), counts(F.col(f"`{text}`")).alias("c"))
    return rows.select("row", "c", *[v.alias(k) for k, v in votes(F.col("c")).items()])


def verdicts(seen: DataFrame, model: Model) -> DataFrame:
    out = seen.withColumn("p_good", posterior(model)).withColumn("base_failed", base_failed(F.col("c")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))


def judge(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row, as struct ``row`` of the columns ``carry``, with ``c`` (counts), ``base_failed``, ``p_good`` and ``kept``.

    One pass over the texts; counts and votes are landed, so the second pass,
    after the fit, reads numbers. Null and empty texts have zero counts and fail;
    repeated rows get equal verdicts; an empty table gives an empty result;
    carried columns stay inside ``row`` and cannot clash.
    """
    seen = land(voted(docs, text, carry), "quality-votes")
    return verdicts(seen, fit(seen))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input rows that are kept, with the input's columns.

    Rows are landed with their votes: one pass counts, and neither the fit nor the
    verdicts work the counts out again.
    """
    seen = land(voted(docs, text), "quality-votes")
    return verdicts(seen, fit(seen)).where("kept").select("row.*")
