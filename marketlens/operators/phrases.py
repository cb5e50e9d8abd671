"""Words of several tokens, found by how much more often two tokens stand side by side than by chance.

A table of pairs is counted over all texts. A run of tokens in which every neighbouring two are a pair of the
table is read from its left as words of up to ``most`` tokens joined by ``_``; a token left over at its end stays
a word of its own. Null and empty texts have no tokens; an empty table leaves all counts as they are.

Texts are normalised once for each step that reads them; for several steps :func:`stored_tokens` does it once for all,
as every ``text`` may hold tokens instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.text import tokens_of
from marketlens.operators.terms import term_counts
from marketlens.session import staged

JOINT = "_"


def stored_tokens(docs: DataFrame, keys: Sequence[str], text: Column) -> DataFrame:
    """(keys, tokens) of every text, written once to the shared folder."""
    return staged(docs.select(*keys, tokens_of(docs, text).alias("tokens")), "tokens")


def _pairs(docs: DataFrame, keys: Sequence[str], text: Column) -> DataFrame:
    """(keys, pos, a, b) for every two neighbouring tokens, ``pos`` the place of the first."""
    tokens = docs.select(*keys, tokens_of(docs, text).alias("_t"))
    pairs = F.expr("transform(slice(_t, 2, size(_t)), (b, i) -> struct(i AS pos, get(_t, i) AS a, b AS b))")
    return tokens.filter(F.size("_t") > 1).select(*keys, F.inline(pairs))


def pair_table(docs: DataFrame, text: Column, min_count: int = 5, least: float = 3.0) -> DataFrame:
    """Pairs (a, b) that occur ``min_count`` times or more with a pointwise mutual information (base 2) of ``least``
    or more, with both.

    Texts are read once: a token is counted with its next one, the last of a text with null, so the counts of tokens
    are sums of those of pairs. Pairs are counted map-side first; rare ones leave before they meet the counts of their tokens.
    """
    follow = F.expr("transform(_t, (a, i) -> struct(a AS a, get(_t, i + 1) AS b))")
    every = docs.select(tokens_of(docs, text).alias("_t")).select(F.inline(follow)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    every = staged(every, "pair-counts")
    counted = every.filter(F.col("b").isNotNull() & (F.col("n") >= min_count))
    single = every.groupBy(F.col("a").alias("token")).agg(F.sum("n").alias("m"))
    # A token of such a pair is as frequent as the pair, and all others are only needed for the total.
    frequent = single.filter(F.col("m") >= min_count)
    total = single.agg(F.sum("m").cast("double").alias("total")).scalar()
    met = counted.join(frequent.toDF("a", "n_a"), "a").join(frequent.toDF("b", "n_b"), "b")
    pmi = F.log2(F.col("n") * total / (F.col("n_a").cast("double") * F.col("n_b")))
    return met.select("a", "b", "n", F.round(pmi, 6).alias("pmi")).filter(F.col("pmi") >= least)


def joined_words(docs: DataFrame, keys: Sequence[str], text: Column, pairs: DataFrame, most: int = 3) -> DataFrame:
    """(keys, word, parts) for every word of two tokens or more in the texts. A key stands for one row of ``docs``.

    Only places where a pair of the table stands are shuffled to their documents.
    """
    found = _pairs(docs, keys, text).join(pairs.select("a", "b"), ["a", "b"], "left_semi")
    place = Window.partitionBy(*keys).orderBy("pos")
    runs = found.withColumn("_run", F.col("pos") - F.row_number().over(place)).withColumn("_last", F.lead("pos").over(place).isNull() | (F.lead("pos").over(place) > F.col("pos") + 1))
    first = F.min("pos").over(Window.partitionBy(*keys, "_run"))
    placed = runs.withColumn("_o", F.col("pos") - first)
    both = F.array(F.struct("_o", F.col("a").alias("token")), F.struct((F.col("_o") + 1).alias("_o"), F.col("b").alias("token")))
    tokens = placed.select(*keys, "_run", F.inline(F.when(F.col("_last"), both).otherwise(F.slice(both, 1, 1))))
    cut = tokens.groupBy(*keys, "_run", F.floor(F.col("_o") / most).alias("_w")).agg(F.array_sort(F.collect_list(F.struct("_o", "token"))).alias("_p"))
    parts = F.transform("_p", lambda p: p["token"])
    return cut.filter(F.size("_p") > 1).select(*keys, F.array_join(parts, JOINT).alias("word"), parts.alias("parts"))


def phrase_counts(docs: DataFrame, keys: Sequence[str], text: Column, pairs: DataFrame, most: int = 3) -> DataFrame:
    """Occurrences ``tf`` of every word of every document, joined words in place of their tokens."""
    met = joined_words(docs, keys, text, pairs, most)
    changes = F.concat(
        F.array(F.struct(F.col("word").alias("token"), F.lit(1).cast("bigint").alias("tf"))),
        F.transform("parts", lambda t: F.struct(t.alias("token"), F.lit(-1).cast("bigint").alias("tf"))),
    )
    changed = met.select(*keys, F.inline(changes))
    counts = term_counts(docs, keys, text).unionByName(changed).groupBy(*keys, "token").agg(F.sum("tf").alias("tf"))
    return counts.filter("tf > 0")
