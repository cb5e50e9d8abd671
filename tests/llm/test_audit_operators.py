"""Embedding near duplicates, source divergence and resampling next to brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from marketlens.llm import divergence, embeddings, queries, resampling
from marketlens.llm.common import pieces, table

LONG = "Word " * 60_000
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# --- embeddings -----------------------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute_links(rows, least=embeddings.LEAST):
    def sound(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [sound(v, label) for _, v, label in rows]
    root, n = list(range(len(rows))), [0] * len(rows)
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            if not (ok[i] and ok[j] and label == rows[j][2] and len(v) == len(rows[j][1])):
                continue
            a, b = np.array(v, np.float64), np.array(rows[j][1], np.float64)
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= least:
                n[i] += 1
                n[j] += 1
                root = [root[j] if x == root[i] else x for x in root]
    out = []
    for i, (key, _, _) in enumerate(rows):
        keys = [rows[k][0] for k in range(len(rows)) if root[k] == root[i] and rows[k][0] is not None]
        component = min(keys) if keys and n[i] else key
        out.append((key, n[i], component, key == component))
    return out


@pytest.fixture(scope="module")
def vectors():
    """Groups of near copies, chains of links, equal rows, vectors that do not count."""
    rng = np.random.default_rng(3)
    found = [(rng.standard_normal(16), 1) for _ in range(250)]
    for size, spread in ((60, 0.03), (40, 0.09), (25, 0.12), (2, 0.02)):
        base = rng.standard_normal(16)
        found += [(base + spread * rng.standard_normal(16), int(rng.integers(0, 2))) for _ in range(size)]
    chain = rng.standard_normal(16)
    for _ in range(30):
        chain = chain + 0.08 * rng.standard_normal(16)
        found.append((chain, 1))
    rows = [(int(7 * i % 1009), [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(found)]
    rows += [(2000 + i, rows[260][1], rows[260][2]) for i in range(20)]
    rows += [(2100, [2 * x for x in rows[260][1]], rows[260][2]), (2101, rows[260][1], None), (2102, rows[260][1][:8], 1), (2103, rows[260][1][:8], 1)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [float("nan")] * 16, 1), (3004, [float("inf")] + [1.0] * 15, 1), (3005, [None] + [1.0] * 15, 1)]
    return [*rows, (None, rows[3][1], rows[3][2]), (None, [1.0] * 16, 0), rows[5], rows[270]]


@pytest.mark.parametrize("cell,block", [(2000, 4096), (20, 4096), (30, 16)])
def test_embedding_links_match_brute_force(spark, vectors, cell, block):
    wide = T.StructType([*VECTORS.fields, T.StructField("n", T.IntegerType()), T.StructField("cls", T.StringType())])
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors], wide)
    got = embeddings.near_duplicates(df.repartition(3), cell=cell, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert order(tuple(r) for r in got.collect()) == order(brute_links(vectors))


def test_embedding_links_across_cells_in_many_dimensions(spark, larger):
    """Cells of 25 on a table with groups of near copies put into it: all links are found."""
    rng = np.random.default_rng(4)
    plain = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, larger, "embeddings").collect()]
    made = []
    for group in range(12):
        base = np.array(plain[group][1])
        for k in range(15):
            noise = rng.standard_normal(64)
            made.append((10_000 + 100 * group + k, [float(np.float32(x)) for x in base + 0.3 * rng.random() * noise / np.linalg.norm(noise)], plain[group][2]))
    rows = plain + made
    got = embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS), cell=25)
    want = brute_links(rows)
    assert sum(r[1] for r in want) > 2000
    assert order(tuple(r) for r in got.collect()) == order(want)


def test_embedding_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_embedding_products_at_the_limit_are_computed_again():
    x = np.array([[1.0, 0.0], [0.6, 0.8]])
    of_x, _, links = embeddings.compare(x, None, np.array([2, 3]), None, 0.6)
    assert of_x.tolist() == [3, 2] and links == [(0, 1)]


# --- divergence -----------------------------------------------------------------------------------


def brute_audit(rows, min_docs=divergence.MIN_DOCS, top=divergence.TOP):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = Counter(TERM.findall(lowered(text)))
        docs[lang or ""].update(found.keys())
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: {t: c[t] for t in kept} for (of, s), c in counts.items() if of == lang}
        total = {t: sum(g[t] for g in groups.values()) for t in kept}

        def shares(found, v=len(kept)):
            whole = sum(found.values()) + 2 * v
            return {t: 1 + 10**9 * (n + 2) // whole for t, n in found.items()}

        priced, whole = {s: shares(g) for s, g in groups.items()}, shares(total)
        for s, p in priced.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), o) for o, q in priced.items() if o != s]
            terms = [((p[t] - whole[t]) ** 2 // (p[t] + whole[t]), t) for t in kept if groups[s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return out


@pytest.fixture(scope="module")
def speakers():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", "Z", None, "hot", "hot", "hot"])
        words = [rng.choice(["W", "w", "é", "ß", "漢字", "x'"]) + rng.choice("abcdefghij") * rng.randrange(1, 9) for _ in range(rng.randrange(60))]
        rows.append((i, rng.choice([" ", "-", "\n", "1"]).join(words), lang, source))
    rows += [(400, LONG, "en", "a"), (401, None, "en", "only"), (402, "", "fr", "x"), (403, "few words", "fr", "y"), (404, "few words", "fr", None)]
    return [*rows, rows[0], rows[1], (None, "Aa bB", "de", "a")]


@pytest.mark.parametrize("width,block", [(divergence.RANGE, divergence.BLOCK), (7, 2)])
def test_divergence_matches_brute_force(documents, speakers, width, block):
    got = divergence.audit(documents(speakers, term="string", n="int", part="int", at="int"), width=width, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank", "p", "q"]
    assert order(tuple(r)[:6] for r in got.collect()) == order(brute_audit(speakers))


def test_divergence_prices_are_exact():
    rng = random.Random(1)
    for _ in range(2000):
        whole = rng.randrange(1, 9 * 10 ** rng.randrange(1, 16))
        n = rng.randrange(0, whole + 1)
        assert int(divergence.price(n, whole)) == 1 + 10**9 * (n + 2) // whole


def test_divergence_of_a_pair_is_the_sum_over_all_terms():
    rng = np.random.default_rng(2)
    for size_a, size_b in ((0, 0), (0, 9), (5, 200), (300, 300)):
        ids = [np.sort(rng.choice(500, n, replace=False)) for n in (size_a, size_b)]
        counts = [rng.integers(1, 50, len(i)) for i in ids]
        wholes = [int(c.sum()) + 1000 for c in counts]
        full = [np.zeros(500, np.int64) for _ in ids]
        for f, i, c in zip(full, ids, counts, strict=True):
            f[i] = c
        p, q = (1 + 10**9 * (f + 2) // w for f, w in zip(full, wholes, strict=True))
        a, b = (divergence.Group(i, c, w) for i, c, w in zip(ids, counts, wholes, strict=True))
        assert divergence.difference(a, b, 500) == divergence.difference(b, a, 500) == int(((p - q) ** 2 // (p + q)).sum())


def test_divergence_empty_table(documents):
    assert divergence.audit(documents([])).collect() == []


# --- resampling -----------------------------------------------------------------------------------


def brute_resample(rows, target, n=1, buckets=resampling.BUCKETS, share=10, least=20):
    def features(text):
        words = WORD.findall(lowered(text))
        runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
        return len(words), [crc32(r.encode()) % buckets for r in runs]

    found = [features(r[1]) for r in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + float(buckets)) / ((s[b] + 1.0) * (big_t + float(buckets))))) for b in s}
    scored = []
    for (key, *_), (n_words, f) in zip(rows, found, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        scored.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    fits = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0], -r[2], -r[1]))
    most = share * len(fits) // 100
    ranked = [(*r[:4], k + 1 if k < most else None) for k, r in enumerate(fits)]
    return ranked + [(*r[:4], None) for r in scored if r[4] < least]


@pytest.mark.parametrize("n,buckets,piece", [(1, 10_000, 4 << 20), (3, 500, 4 << 20), (2, 10_000, 40)])
def test_resampling_matches_brute_force(spark, documents, speakers, n, buckets, piece):
    rows = [r for r in speakers if r[1] != LONG] + [(9000, "Word word2 wörd " * 500, "en", "a")]
    target = ["wa Wbb éaa few words", None, "", "word2 " * 30]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(documents(rows, n="int", rank="int", at="int"), aim, n=n, buckets=buckets, piece=piece)
    assert order((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == order(brute_resample(rows, target, n, buckets))


def test_resampling_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(documents([]), none).collect() == []
    rows = [(1, "a b"), (2, None)]
    assert order(tuple(r)[0:1] + tuple(r)[2:] for r in resampling.resample(documents(rows), none).collect()) == order(brute_resample(rows, []))


def test_sampled_rows_keep_their_columns(spark, documents, speakers):
    docs = documents([r for r in speakers if r[0] is not None][:300], rank="int")
    aim = spark.createDataFrame([(1, "wa wb")], "item_id long, text string")
    kept = resampling.sampled(docs, aim, share=50)
    drawn = {r["doc_id"] for r in resampling.resample(docs, aim, share=50).filter("rank IS NOT NULL").collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == drawn and drawn


def test_pieces_keep_every_word():
    rng = random.Random(6)
    for most in (1, 3, 10, 1000):
        text = b"".join(rng.choice([b"a", b"bc", b" ", b"  ", b"-", b"x" * 30]) for _ in range(300))
        cut = list(pieces(text, resampling.SEPARATE, most))
        assert [w for p in cut for w in p.split()] == text.translate(resampling.SEPARATE).split()


@pytest.mark.parametrize("name", ["op11_embedding_dedup", "op12_source_audit", "op13_target_resampling"])
def test_sql_agrees_on_planted_rows(spark, documents, speakers, vectors, tmp_path, name):
    """The SQL sees what the given tables lack: links, nulls, other letters."""
    con = duckdb.connect()
    target = ["wa Wbb éaa few words", None, "", "word2 " * 30]
    docs = [r for r in speakers if r[1] != LONG]
    documents(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(target)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(vectors, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    sql = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert order(tuple(r) for r in got.collect()) == order(sql)
