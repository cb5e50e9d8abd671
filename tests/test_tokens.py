"""Texts normalised once for several steps."""

from collections import Counter

from pyspark.sql import functions as F

from marketlens.functions import text as TX
from marketlens.operators import phrases

TEXTS = [(1, "New York, new york and more"), (2, "new york"), (2, "new york"), (None, "a new york"), (3, None), (4, ""), (5, "york"), (6, "see www.a.bc/x new york")]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_pairs_are_counted_from_one_normalisation(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "id int, t string")
    asked, own = [], TX.normalize_text
    monkeypatch.setattr(TX, "normalize_text", lambda c: asked.append(c) or own(c))
    got = {(r["a"], r["b"]): (r["n"], r["pmi"]) for r in phrases.pair_table(docs, F.col("t"), 2, 0.0).collect()}
    # Of 17 tokens 6 are "new" and 7 are "york", which follows it 6 times.
    assert got == {("new", "york"): (6, 1.280108)}
    assert len(asked) == 1


def test_stored_tokens_stand_for_texts(spark):
    docs = spark.createDataFrame(TEXTS, "id int, t string")
    tokens = phrases.stored_tokens(docs, ["id"], F.col("t"))
    pairs = phrases.pair_table(docs, F.col("t"), 2, 0.0)
    assert rows(phrases.pair_table(tokens, F.col("tokens"), 2, 0.0)) == rows(pairs)
    want = rows(phrases.phrase_counts(docs, ["id"], F.col("t"), pairs))
    assert rows(phrases.phrase_counts(tokens, ["id"], F.col("tokens"), pairs)) == want and want
