import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators import keys, phrases, terms, text_index
from marketlens.session import fresh_path, staged
from marketlens.sources.bucketed import drop_bucketed, write_bucketed
from marketlens.sources.files import partition_folders
from marketlens.sources.partitioned import read_partitioned, upsert_partitions
from marketlens.streaming import incremental

TEXTS = [
    "học sinh giỏi đọc sách giáo khoa mới", "học sinh đọc sách giáo khoa", "sách giáo khoa học sinh học sinh",
    "sinh giáo khoa", "giỏi", "", None, "mới học sinh giỏi mới đọc", "học sinh học sinh học sinh học",
]


def _docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")


def _brute_pairs(texts, min_count, least):
    tokens = [(t or "").split() for t in texts]
    single, pairs = Counter(w for t in tokens for w in t), Counter(p for t in tokens for p in zip(t, t[1:]))
    total = sum(single.values())
    pmi = {p: round(math.log2(n * total / (single[p[0]] * single[p[1]])), 6) for p, n in pairs.items() if n >= min_count}
    return {p: (pairs[p], v) for p, v in pmi.items() if v >= least}


def _brute_words(tokens, pairs, most):
    out, i = [], 0
    while i < len(tokens):
        end = i + 1
        while end < len(tokens) and (tokens[end - 1], tokens[end]) in pairs:
            end += 1
        out += ["_".join(tokens[at : min(at + most, end)]) for at in range(i, end, most)]
        i = end
    return out


@pytest.mark.parametrize("most", [2, 3, 4])
def test_words_of_several_tokens(spark, most):
    docs = _docs(spark)
    table = phrases.pair_table(docs, F.col("text"), 2, 0.5)
    want = _brute_pairs(TEXTS, 2, 0.5)
    assert want and {(r["a"], r["b"]): (r["n"], r["pmi"]) for r in table.collect()} == want
    got = phrases.phrase_counts(docs, ["k"], F.col("text"), table, most).collect()
    brute = {(k, w): n for k, t in enumerate(TEXTS) for w, n in Counter(_brute_words((t or "").split(), want, most)).items()}
    assert {(r["k"], r["token"]): r["tf"] for r in got} == brute
    assert any("_" in w for _, w in brute)


def test_joined_stop_words_and_no_pairs(spark):
    docs = _docs(spark)
    table = phrases.pair_table(docs, F.col("text"), 2, 0.5)
    vocab = lambda stops: {r["token"] for r in terms.vocabulary(phrases.phrase_counts(docs, ["k"], F.col("text"), table, 2), stops).collect()}
    assert vocab([]) - vocab(["học_sinh"]) == {"học_sinh"}
    plain = phrases.phrase_counts(docs, ["k"], F.col("text"), table.limit(0))
    assert sorted(plain.collect()) == sorted(terms.term_counts(docs, ["k"], F.col("text")).collect())
    none = docs.limit(0)
    assert phrases.pair_table(none, F.col("text")).count() == 0 and phrases.phrase_counts(none, ["k"], F.col("text"), table).count() == 0


def _weights(rows):
    return {(r["k"], r["token"]): (r["tf"], r["df"], round(r["weight"], 9)) for r in rows.collect()}


def test_index_by_drops_equals_a_rebuild(spark, monkeypatch):
    base, kinds, schema = fresh_path(spark, "index"), [("k", T.LongType())], "k bigint, text string"
    drops = [[(1, "a b b c"), (2, "b c"), (3, None), (None, "a")], [(4, "a d d"), (2, "a a d")], [], [(3, "c c b"), (1, "")]]
    held = {}
    for i, rows in enumerate(drops):
        for _ in range(2):  # a repeated load replaces itself
            text_index.add_drop(spark.createDataFrame(rows, schema), base, ["k"], F.col("text"), i)
        held |= {k: t for k, t in rows if k is not None}
        docs = spark.createDataFrame(list(held.items()), schema)
        counts = terms.term_counts(docs, ["k"], F.col("text"))
        n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
        want = terms.tfidf(counts, terms.vocabulary(counts), n, ["k"])
        assert _weights(text_index.current_weights(spark, base, kinds)) == _weights(want)
        assert text_index.current_size(spark, base).first()[0] == len(held)
    # Only the tokens that a load changes are written by it.
    changes = spark.read.parquet(f"{base}/df/load=3")
    assert {r["token"]: r["df"] for r in changes.collect()} == {"a": -1}
    # A load that dies before its keys are stored is not read, and counts once when it is repeated.
    before, late = _weights(text_index.current_weights(spark, base, kinds)), spark.createDataFrame([(9, "a b c d")], schema)
    text_index.add_drop(late, base, ["k"], F.col("text"), 4)
    whole = _weights(text_index.current_weights(spark, base, kinds))
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/held/load=4/_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, False)
    assert _weights(text_index.current_weights(spark, base, kinds)) == before != whole
    text_index.add_drop(late, base, ["k"], F.col("text"), 4)
    assert _weights(text_index.current_weights(spark, base, kinds)) == whole


def _names(spark, path):
    return {f.rsplit("/", 1)[1]: {str(r[0]) for r in spark.read.parquet(f).select("_metadata.file_name").collect()} for f in partition_folders(spark, path)}


def test_upsert_overwrites_only_the_partitions_it_touches(spark):
    path = fresh_path(spark, "parted")
    upsert_partitions(spark.range(200).selectExpr("id as k", "'a' as v"), path, ["k"], 16, "0")
    first = _names(spark, path)
    for i, rows in enumerate(([(5, "v")], [], [(5, "w"), (500, "x")]), 1):
        upsert_partitions(spark.createDataFrame(rows, "k bigint, v string"), path, ["k"], 16, str(i))
    last = _names(spark, path)
    assert 1 <= sum(first[b] != last[b] for b in first) <= 2 and len(first) == 16
    got = {r["k"]: r["v"] for r in read_partitioned(spark, path).collect()}
    assert len(got) == 201 and (got[5], got[500], got[6]) == ("w", "x", "a")


def test_a_batch_cut_off_while_put_in_place_is_mended_by_its_repeat(spark):
    path, fs = fresh_path(spark, "parted"), None
    upsert_partitions(spark.range(50).selectExpr("id as k", "'a' as v"), path, ["k"], 4, "0")
    batch = spark.createDataFrame([(k, "b") for k in range(0, 60, 3)], "k bigint, v string")
    upsert_partitions(batch, path, ["k"], 4, "1")
    want = sorted(read_partitioned(spark, path).collect())
    for folder in partition_folders(spark, path)[:2]:
        gone = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = gone.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(gone, True)
    assert read_partitioned(spark, path).count() < len(want)
    upsert_partitions(batch, path, ["k"], 4, "1")
    assert sorted(read_partitioned(spark, path).collect()) == want and len(want) == 53
    assert not any(f.endswith("/0") for f in [s.getPath().toString() for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}-staged"))])


def test_stream_upserts_partitions_and_refuses_null_keys(spark):
    base = fresh_path(spark, "stream")
    run = incremental.upsert_partition_batches(f"{base}/t", ["k"], [F.desc("t")], 4)
    schema = "k int, t int, v string"
    for i, rows in ((0, [(1, 1, "a"), (1, 2, "b"), (None, 1, "n"), (2, 1, "c")]), (1, [(1, 3, "x"), (None, 2, "m")]), (1, [(1, 3, "x"), (None, 2, "m")])):
        run(batch := spark.createDataFrame(rows, schema), i)
    assert sorted(tuple(r) for r in read_partitioned(spark, f"{base}/t").collect()) == [(1, 3, "x"), (2, 1, "c")]
    refused = incremental.read_refused(spark, f"{base}/t", batch.schema)
    assert sorted(r["v"] for r in refused.collect()) == ["m", "n"]


def test_existence_tests_on_bucketed_tables_move_nothing(spark):
    path = fresh_path(spark, "bucketed")
    big = spark.range(300).selectExpr("if(id % 50 = 0, null, id % 40) as k", "id as v")
    small = spark.range(0, 60, 3).toDF("k")
    a, b = (write_bucketed(df, f"{n}_test_bucketed", f"{path}/{n}", ["k"], 8) for n, df in (("a", big), ("b", small)))
    for test in (keys.existing, keys.unknown):
        got = test(a.hint("merge"), b.hint("merge"), ["k"], unique=True)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(got.collect(), key=str) == sorted(test(big, small, ["k"]).collect(), key=str)
    for n in "ab":
        drop_bucketed(spark, f"{n}_test_bucketed")


def test_a_drop_stores_its_counts_once(spark, monkeypatch):
    """the counts of a drop are written to their place and nowhere else."""
    labels = []

    def noted(df, label, by=None):
        labels.append((label, "tf" in df.columns))
        return staged(df, label, by)

    monkeypatch.setattr(text_index, "staged", noted)
    base, kinds = fresh_path(spark, "index"), [("id", T.LongType())]
    for load, rows in enumerate([[(1, "a b"), (2, "b b"), (None, "c")], [(1, "c c c"), (3, "a")], [(1, None), (4, "d")]]):
        text_index.add_drop(spark.createDataFrame(rows, "id long, text string"), base, ["id"], F.col("text"), load)
    found = {tuple(r) for r in text_index.current_counts(spark, base, kinds).collect()}
    assert found == {(2, "b", 2), (3, "a", 1), (4, "d", 1)}
    assert not any(has_counts for _, has_counts in labels)
