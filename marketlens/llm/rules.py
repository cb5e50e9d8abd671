"""Quality rules as weak supervision.

Each rule votes good (1), bad (0) or abstains (null) on a document. Expectation-maximisation
estimates, without labels, how often the votes of each rule are right and how common good documents
are; the posterior probability of being good replaces an all-rules-must-pass filter.
Documents are counted by vote pattern first (at most 3 to the number of rules), so an iteration
reads a table of bounded size, and only the fitted rates reach the driver.

Null text counts as empty: no words, base_failed, not kept. Empty tables give empty results; repeated
rows each get their own row; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import BLANKS
from marketlens.session import discard, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 12
START_RATE, START_PRIOR = 0.8, 0.8
STRENGTH = 20.0  # pseudo-votes that hold a rate near its start

# rule: (measure, good below, bad above); None: the rule never votes that way
RULES = {
    "symbols": ("n_symbols / n_words", 0.05, 0.2),
    "exclaiming": ("n_exclaim / n_words", None, 0.25),
    "odd_words": ("n_odd / n_words", 0.05, 0.2),
    "shouting": ("n_upper / word_chars", None, 0.4),
    "repeats": ("n_repeat_words / n_words", None, 0.4),
    "same_lines": ("n_dup_lines / n_lines", None, 0.5),
    "long_words": ("word_chars / n_words", None, 14.0),
}


def measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts per document beside the struct ``row`` of the columns to keep (all, unless named).

    Repeats are found inside the row, by sorting the hashes of the text's 3-word windows.
    """
    kept = F.struct(*(docs[c] for c in keep or docs.columns)).alias("row")
    words = F.filter(F.split("t", f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: F.ltrim(x, F.lit(BLANKS)) != "")
    length = F.length("t").cast("long")

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace("t", pattern, ""))

    split = docs.select(kept, F.coalesce(docs[text], F.lit("")).alias("t")).select(
        "row",
        words.alias("w"),
        lines.alias("l"),
        (length - without(f"[{SYMBOLS}]+")).alias("n_symbols"),
        (length - F.length(F.replace("t", F.lit("!"), F.lit("")))).alias("n_exclaim"),
        (length - without("[A-Z]+")).alias("n_upper"),
    )
    counts = ["row", "n_symbols", "n_exclaim", "n_upper"]
    counted = split.select(
        *counts,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda w: w.rlike(f"[{SYMBOLS}!]"))).cast("long").alias("n_odd"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
    )
    counts += ["n_words", "word_chars", "n_lines", "n_dup_lines", "n_odd"]
    window = F.expr("transform(slice(h, 1, greatest(size(h) - 2, 0)), (x, i) -> xxhash64(x, get(h, i + 1), get(h, i + 2)))")
    windows = counted.select(*counts, window.alias("k"))
    # A text without a repeat is done; else equal neighbours in order of (hash, place) are the repeats.
    some = F.size(F.array_distinct("k")) < F.size("k")
    ordered = windows.select(*counts, F.when(some, F.sort_array(F.transform("k", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    repeated = F.expr("sort_array(transform(filter(s, (x, i) -> x.h <=> get(s, i - 1).h or x.h <=> get(s, i + 1).h), x -> x.i))")
    covered = F.expr("aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1) - x, 3))), 0L, (n, x) -> n + x)")
    places = ordered.select(*counts, repeated.alias("p"))
    return places.select(*counts, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def vote(measure: Column, good: float | None, bad: float) -> Column:
    """1 below ``good``, 0 above ``bad``, null between them or where there is nothing to measure."""
    no = F.when(measure > bad, 0)
    return no if good is None else no.when(measure < good, 1)


def votes(measured: DataFrame) -> DataFrame:
    def ratio(text: str) -> Column:
        top, under = text.split(" / ")
        return F.expr(f"{top} / nullif({under}, 0)")

    return measured.withColumns({f"v_{r}": vote(ratio(m), good, bad) for r, (m, good, bad) in RULES.items()})


def _posterior(rates: dict[str, float], prior: float) -> Column:
    """Probability that a row is good, given how often each rule's votes are right."""
    # One array for all rates: the generated code stays the same from round to round.
    held = F.lit([float(prior), *map(float, rates.values())])
    good, bad = held[0], 1.0 - held[0]
    for k, rule in enumerate(rates, 1):
        v, right = F.col(f"v_{rule}"), held[k]
        good = good * F.when(v == 1, right).when(v == 0, 1.0 - right).otherwise(1.0)
        bad = bad * F.when(v == 1, 1.0 - right).when(v == 0, right).otherwise(1.0)
    return good / (good + bad)


def fit(voted: DataFrame, rounds: int = ROUNDS) -> tuple[dict[str, float], float]:
    """Accuracy of each rule and the share of good rows, by expectation-maximisation over vote patterns."""
    names = [f"v_{r}" for r in RULES]
    patterns = staged(voted.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    rates, prior = {r: START_RATE for r in RULES}, START_PRIOR
    n, p = F.col("n"), F.col("p")
    sums = [F.sum(n * p).alias("good"), F.sum(n).alias("all")]
    for r in RULES:
        v = F.col(f"v_{r}")
        sums.append(F.sum(n * F.when(v == 1, p).when(v == 0, 1 - p).otherwise(0.0)).alias(f"{r}_right"))
        sums.append(F.sum(F.when(v.isNotNull(), n).otherwise(0)).alias(f"{r}_all"))
    for _ in range(rounds):
        row = patterns.withColumn("p", _posterior(rates, prior)).agg(*sums).first()
        if not row["all"]:
            break
        rates = {r: (row[f"{r}_right"] + START_RATE * STRENGTH) / (row[f"{r}_all"] + STRENGTH) for r in RULES}
        prior = (row["good"] + START_PRIOR * STRENGTH) / (row["all"] + STRENGTH)
    discard(patterns)
    return rates, prior


def judged(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The measures of every row with ``base_failed``, ``p_good`` and ``kept``."""
    measured = staged(votes(measures(docs, text, keep)), "measures")
    rates, prior = fit(measured.filter(F.col("n_words") >= MIN_WORDS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = measured.withColumns({"base_failed": failed, "p_good": _posterior(rates, prior)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: base counts, ``base_failed``, ``kept`` and the posterior ``p_good``."""
    return judged(docs, text, [key]).select(
        F.col("row")[key].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good",
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    return judged(docs, text).filter("kept").select("row.*")
