"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of source, language and topic; the token weights of the cells are raked
in turn to the target shares of each margin, round after round. A document's weight is its cell's
raked over its counted tokens; documents are sampled with probabilities in proportion to it, scaled so
that the expected number of tokens is the budget. Where a probability would pass 1 it is held there and
the rest is scaled up.

Targets may be given per margin as a table (value, share); by default a margin's counted shares are
flattened by a power, so that small sources and languages gain and large ones lose. The topic is the
first cue group whose words the text holds.

Everything is DataFrame operations. Only cells, which are as many as combinations of margin values,
are raked; a hot source is summed before it is shuffled. Documents meet their cell's probability by a
join on the cell, which splits hot cells at run time. Whether a document is drawn depends on a hash of
its key alone, so runs agree.

Null sources, languages and texts count as values of their own ("", and topic "none" for null and
blank texts); tokens are blank-separated words, so texts without words weigh nothing, have
probability 0 and are not drawn. Repeated rows are drawn together; rows with a null key count as one
key. An empty table gives an empty result. Columns of the input stay as they are; the operator's own
are named in ``OWN``, and input columns of these names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import BLANKS
from marketlens.session import discard, staged

ROUNDS = 10
CLIP_ROUNDS = 8
POWER = 0.7
BUDGET = 0.8  # of all tokens
TOPICS = {
    "license": ["license", "copyright"],
    "settings": [" = ", "token", "password"],
    "contact": ["@", "phone"],
    "table": [" | "],
}
MARGINS = ["source", "lang", "topic"]
OWN = ["topic", "tokens", "weight", "probability", "sampled"]


def topic(text: Column) -> Column:
    found = F.when(F.ltrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)) == "", "none")
    low = F.lower(text)
    for name, cues in TOPICS.items():
        held = low.contains(cues[0])
        for cue in cues[1:]:
            held = held | low.contains(cue)
        found = found.when(held, name)
    return found.otherwise("prose")


def tokens(text: Column) -> Column:
    """Blank-separated words: places where a word begins."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), lambda w: w != "")).cast("long")


def draw(key: Column) -> Column:
    """A number in [0, 1) from a hash of the key."""
    code = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(code, 1, 8), 16, 10).cast("double") / 4294967296.0


def flattened(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its counted shares to a power, made to add up to 1."""
    counted = cells.groupBy(margin).agg(F.sum("tokens").alias("n")).filter("n > 0").withColumn("x", F.pow("n", F.lit(power)))
    total = counted.agg(F.sum("x")).first()[0]
    return counted.select(F.col(margin).alias("value"), (F.col("x") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margins, tokens) with ``raked``, whose sums over each margin follow the targets.

    A margin value without a target keeps no weight; a target without cells is left out of its margin.
    The targets are joined once; a margin's sums are then windows over the cells, and every round is the
    same plan over the table that the round before has written.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    raked = cells.withColumn("raked", F.col("tokens").cast("double"))
    for margin, target in targets.items():
        aim = target.select(F.col("value").alias(f"value_{margin}"), F.col("share").alias(f"share_{margin}"))
        raked = raked.join(aim, raked[margin] == aim[f"value_{margin}"], "left").drop(f"value_{margin}")
    raked = before = staged(raked, "raked")
    for _ in range(rounds):
        for margin in targets:
            now = F.sum("raked").over(Window.partitionBy(margin))
            fitted = F.when(now > 0, F.col("raked") * (F.col(f"share_{margin}") * total / now))
            raked = raked.withColumn("raked", F.coalesce(fitted, F.lit(0.0)))
        raked = staged(raked, "raked")
        discard(before)
        before = raked
    return raked.drop(*(f"share_{m}" for m in targets))


def probabilities(raked: DataFrame, budget: float) -> DataFrame:
    """``weight`` and ``probability`` of a document of each cell, for ``budget`` expected tokens."""
    rated = raked.filter("tokens > 0").withColumn("weight", F.col("raked") / F.col("tokens"))
    scale = 0.0
    for _ in range(CLIP_ROUNDS):
        full = (F.col("weight") * scale >= 1.0) if scale else F.lit(False)
        row = rated.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("raked"))).alias("free")).first()
        if not row["free"]:
            break
        scale = (budget - row["held"]) / row["free"]
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * scale))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, power: float = POWER) -> DataFrame:
    """``docs`` with topic, tokens, weight, probability and whether each row is sampled."""
    kept = [c for c in docs.columns if c not in OWN]
    counted = docs.select(
        F.struct(*(docs[c] for c in kept)).alias("row"),
        F.coalesce(docs[source].cast("string"), F.lit("")).alias("source"),
        F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"),
        topic(docs[text]).alias("topic"),
        tokens(docs[text]).alias("tokens"),
        draw(docs[key]).alias("draw"),
    )
    cells = staged(counted.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    aims = {m: staged(t, "targets") for m, t in {m: (targets or {}).get(m) or flattened(cells, m, power) for m in MARGINS}.items()}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rated = staged(probabilities(rake(cells, aims), budget * total), "rated")
    rated = rated.select(*(F.col(m).alias(f"of_{m}") for m in MARGINS), "weight", "probability")
    same = [counted[m] == rated[f"of_{m}"] for m in MARGINS]
    met = counted.join(rated, same, "left")
    some = F.col("tokens") > 0
    return met.select(
        "row.*",
        "topic",
        "tokens",
        F.when(some, F.col("weight")).otherwise(0.0).alias("weight"),
        F.when(some, F.col("probability")).otherwise(0.0).alias("probability"),
        (some & F.coalesce(F.col("draw") < F.col("probability"), F.lit(False))).alias("sampled"),
    )
