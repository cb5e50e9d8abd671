"""Near duplicates, repeated passages, test items, mixing and the pipeline, next to brute force."""

import hashlib
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens import session
from marketlens.llm import decontaminate, jaccard, mixing, sketch, substrings
from marketlens.llm.common import gram_hashes, mixed, table
from marketlens.llm.graph import components
from marketlens.session import staged

LONG = "word " * 60_000


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    """Exact and near copies in groups from two to many, short texts, shared passages, nulls and repeats."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.randrange(1, 120)) for _ in range(150)]
    shared = sentence(rng, 60)
    texts += [f"{sentence(rng, 20)} {shared} {sentence(rng, rng.randrange(40))}" for _ in range(40)]
    for size, copies, share in ((60, 60, 0.03), (200, 30, 0.04), (12, 20, 0.05), (6, 20, 0.1), (40, 2, 0.02)):
        base = sentence(rng, size)
        texts += [edited(rng, base, share) for _ in range(copies)]
    texts += [sentence(rng, 30)] * 25 + [None, None, "", " \t\n", "one", "one", "One", "a b", "b a", "a b c d", "a b c d e", "A B c d e"]
    texts += ["same " * 100, "same " * 90, "same " * 5, LONG, LONG.upper(), "\x1c".join("abcde"), "a b c"]
    rows = [(3 * i % 1009, t) for i, t in enumerate(texts)]
    return [*rows, (None, "one"), (None, sentence(rng, 30)), rows[0], rows[160]]


# --- n-gram Jaccard join --------------------------------------------------------------------------


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = blank_words(words)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        out.append((key, len(sets[i]), min(keys) if keys and sets[i] else key))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_jaccard_components_match_brute_force(documents, corpus):
    got = jaccard.jaccard_components(documents(corpus, row="int", comp="int", size="int"))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert order(tuple(r) for r in got.collect()) == order(brute_components(corpus))


def test_blocks_give_the_same_components(documents, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    got = jaccard.jaccard_components(documents(corpus))
    assert order(tuple(r) for r in got.collect()) == order(brute_components(corpus))


@pytest.mark.parametrize("light", [0, 10_000])
def test_heavy_and_light_alone_give_the_same_components(documents, corpus, monkeypatch, light):
    few = [(k, t) for k, t in corpus if len(t or "") < 400]
    monkeypatch.setattr(jaccard, "boundary", lambda mean_list: light)
    got = jaccard.jaccard_components(documents(few))
    assert order(tuple(r) for r in got.collect()) == order(brute_components(few))


def test_one_row_of_a_component_stays(documents, corpus):
    docs = documents(corpus, number="string", kind="int")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute_components(corpus)
    empty = sum(not n for _, n, _ in want)
    names = {c for k, n, c in want if n and c is not None}
    alone = sum(1 for k, n, c in want if n and c is None)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == empty + len(names) + alone
    assert names <= set(ids)


def test_a_full_sketch_stores_neither_sets_nor_texts(documents, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{w}" for w in rng.integers(0, 10**6, 400))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(20)] + [(2000, rows[5][1]), (3, rows[3][1])]
    stored, size = [], sum(len(t) for _, t in rows)

    def recorded(df, label, by=None):
        table = staged(df, label, by=by)
        stored.append(sum(f.stat().st_size for f in Path(table._staged_at).rglob("*.parquet")))
        return table

    monkeypatch.setattr(jaccard, "MOST_WIDTH", 1 << 16)
    monkeypatch.setattr(jaccard, "staged", recorded)
    got = jaccard.jaccard_components(documents(rows))
    assert order(tuple(r) for r in got.collect()) == order(brute_components(rows))
    assert sum(stored) < size / 4
    stored.clear()
    kept = jaccard.keep_one(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    assert sum(stored) < size / 4


def test_rows_that_differ_in_nulls_only_are_not_taken_for_each_other(documents):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a", None), (2, text, None, "a"), (3, None, "a", None), (3, None, None, "a"), (1, text, "a", None)]
    kept = jaccard.keep_one(documents(rows))
    assert order((r.doc_id, r.text, r.lang, r.source) for r in kept.collect()) == order([rows[0], rows[2], rows[3]])


def test_what_may_link_is_met():
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = rng.integers(0, 1 << 62, 90).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(90) < rng.choice([0.3, 0.9, 1.0])], rng.integers(0, 1 << 62, rng.integers(3, 40)).astype(np.uint64)])) for _ in range(rng.integers(2, 14))]
        sizes = [len(s) for s in sets]
        n = len(sets)
        pairs, chains = jaccard.met(np.full(n, 7, np.uint64), np.array(sizes, np.uint16), np.arange(n))
        label = list(range(n))
        for a, b in [*chains.tolist(), *pairs.tolist()]:
            if (a, b) in {tuple(c) for c in chains.tolist()} or jaccard.may_link(jaccard.parity_marks(sets[a]), jaccard.parity_marks(sets[b]), sizes[a] + sizes[b]):
                label = [label[a] if x == label[b] else x for x in label]
        for a in range(n):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 75 * (sizes[a] + sizes[b] - both):
                    assert label[a] == label[b]


def test_the_pipeline_keeps_no_stage_that_is_read(spark, sf):
    before = set(session._STAGED)
    corpus_pipeline.run(spark, sf).count()
    left = [p for p in session._STAGED if p not in before and re.search("/(quality_rules|near_duplicates|decontamination|secret_scan)-", p)]
    assert [Path(p).name.rsplit("-", 1)[0] for p in left] == ["secret_scan"]


def test_jaccard_on_an_empty_table(documents):
    assert jaccard.jaccard_components(documents([]).limit(0)).collect() == []
    assert jaccard.keep_one(documents([(1, None)])).count() == 1


def test_links_connect_what_is_connected():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = np.sort(rng.choice(10**6, 40, replace=False)).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(25, 41)], rng.integers(10**7, 10**8, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(25)]
        want, got = list(range(25)), list(range(25))
        for i in range(25):
            for j in range(i):
                o = len(np.intersect1d(sets[i], sets[j]))
                if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o) and want[i] != want[j]:
                    want = [want[j] if x == want[i] else x for x in want]
        for i, j in jaccard.links(sets):
            assert got[i] != got[j]
            got = [got[j] if x == got[i] else x for x in got]
        assert {(a == b) == (c == d) for a, c in zip(want, got) for b, d in zip(want, got)} == {True}


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.union(spark.createDataFrame([(900, 800), (800, 900), (7, 7), (None, 3)], "a long, b long"))
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 900: 800}


def test_sketch_never_counts_too_low(spark):
    rng = np.random.default_rng(1)
    hashes = mixed(rng.integers(0, 5000, 20_000).astype(np.uint64))
    rows = []
    for part in np.array_split(hashes, 7):
        rows += [(b, p) for batch in sketch.parts(sketch.cells(part, 1 << 16, 2)) for b, p in zip(*(c.to_pylist() for c in batch.columns))]
    merged = sketch.merge(spark.createDataFrame(rows, sketch.PART))
    found = sketch.Sketch.load(merged, 1 << 16, 2)
    values, n = np.unique(hashes, return_counts=True)
    assert (sketch.LEVELS[found.levels(values)] <= n).mean() > 0.9
    assert (found.levels(values) >= np.searchsorted(sketch.LEVELS, n, side="right") - 1).all()
    assert (found.levels(mixed(np.arange(10**6, 10**6 + 500, dtype=np.uint64))) == 0).mean() > 0.9


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 35])
def test_gram_hashes_depend_on_the_run_alone(n):
    words = mixed(np.arange(100, dtype=np.uint64) % np.uint64(50))
    hashes = gram_hashes(words, n)
    assert len(hashes) == 101 - n and len(set(hashes.tolist())) == min(50, 101 - n)
    assert (gram_hashes(words[7 : 10 + n], n) == hashes[7:11]).all()


# --- substring dedup ------------------------------------------------------------------------------


def brute_substrings(rows, window=35):
    words = [blank_words(t) for _, t in rows]
    seen = {}
    for i, w in enumerate(words):
        for k in range(len(w) - window + 1):
            seen.setdefault(tuple(w[k : k + window]), []).append((i, k))
    gone = [set() for _ in words]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + window))
    return [
        (key, len(w), len(g), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in g).encode()).hexdigest())
        for (key, _), w, g in zip(rows, words, gone, strict=True)
    ]


def test_substrings_match_brute_force(documents, corpus):
    rng = random.Random(9)
    passage = sentence(rng, 35)
    rows = [(k, t) for k, t in corpus if t is None or len(t) < 100_000]
    rows += [(5000, f"{passage} tail"), (5001, f"head {passage}"), (5002, passage[:-1]), (5003, f"x {passage} y {passage} z"), (5004, "same " * 36), (5005, "solo " * 35)]
    got = substrings.dedup_substrings(documents(rows, kind="int", number="int"))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert order(tuple(r) for r in got.collect()) == order(brute_substrings(rows))


def test_substrings_with_a_sketch_that_separates_nothing(documents, corpus, monkeypatch):
    rows = [(k, t) for k, t in corpus if t is None or len(t) < 100_000]
    monkeypatch.setattr(sketch.Sketch, "levels", lambda self, h: np.full(len(h), 15))
    got = substrings.dedup_substrings(documents(rows))
    assert order(tuple(r) for r in got.collect()) == order(brute_substrings(rows))


def test_substrings_of_long_and_no_texts(documents):
    rows = [(1, LONG), (2, None), (2, None)]
    assert order(tuple(r)[:3] for r in substrings.dedup_substrings(documents(rows)).collect()) == [(1, 60_000, 60_000), (2, 0, 0), (2, 0, 0)]
    assert substrings.dedup_substrings(documents([]).limit(0)).collect() == []


# --- decontamination ------------------------------------------------------------------------------


def brute_align(item, passage):
    best = (0, 0, 0)
    above = [(0, j) for j in range(len(passage) + 1)]
    for a in item:
        row = [(0, 0)]
        for j, b in enumerate(passage, 1):
            row.append(max((0, j), (above[j - 1][0] + (2 if a == b else -1), above[j - 1][1]), (above[j][0] - 1, above[j][1]), (row[-1][0] - 1, row[-1][1])))
        for j, (score, start) in enumerate(row):
            if score > best[0]:
                best = score, start, j
        above = row
    return best


def test_alignment_matches_the_textbook():
    rng = random.Random(2)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 15))]
        passage = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        score, start, end = decontaminate.align(np.array(item), np.array(passage))
        assert score == brute_align(item, passage)[0]
        if score:
            assert brute_align(item, passage[start:end])[0] == score


ITEMS = [(1, "the quick brown fox jumps over the lazy dog near the old stone bridge at noon today"), (2, "Ünique wörds ÄRE found here among many others of their kind every single day"), (3, None), (4, "two words"), (1, None)]


def test_contaminated_documents(spark, documents):
    rng = random.Random(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    first = ITEMS[0][1]
    rows = [
        (1, f"{sentence(rng, 50)} {first} {sentence(rng, 30)}"), (2, first.upper().replace(" ", "*** ")),
        (3, first.replace("lazy", "sleepy").replace("old ", "very old ")), (4, sentence(rng, 200)), (5, None), (6, ""), (7, "two words"),
        (8, "the quick brown fox is not enough " + sentence(rng, 40)), (9, "start " + ITEMS[1][1].upper()), (None, first), (1, first), (10, LONG + first),
    ]
    docs = documents(rows, item_id="int", score="int")
    got = decontaminate.contaminated(docs, items)
    found = order((r.doc_id, r.item_id) for r in got.collect())
    assert found == order([(1, 1), (1, 1), (2, 1), (3, 1), (9, 2), (None, 1), (10, 1)])
    scores = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert scores[10, 1].score == 1.0 and scores[10, 1].first_word == 60_000 and 0.5 < scores[3, 1].score < 1
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 8]


def test_items_in_blocks_give_the_same(spark, documents, monkeypatch):
    rng = random.Random(6)
    texts = [sentence(rng, 30, 5000) for _ in range(12)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = documents([(i, f"{sentence(rng, 20)} {edited(rng, t, 0.1)}") for i, t in enumerate(texts)])
    whole = order(tuple(r) for r in decontaminate.contaminated(docs, items).collect())
    assert [r[:2] for r in whole] == [(i, i) for i in range(12)]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert [r[:2] for r in order(tuple(r) for r in decontaminate.contaminated(docs, items).collect())] == [r[:2] for r in whole]
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []


@pytest.mark.parametrize("kept", [lambda i: i % 6 != 5, lambda i: i < 4 or i % 4 != 0], ids=["two-grams-a-run", "one-gram-in-all"])
def test_a_verbatim_copy_does_not_hide_frequent_edited_ones(spark, documents, kept):
    rng = random.Random(8)
    words = [f"i{k}" for k in range(42)]
    copy = " ".join(w if kept(i) else f"x{i}" for i, w in enumerate(words))
    rows = [(i, f"{sentence(rng, 30)} {copy} {sentence(rng, 20)}") for i in range(15)] + [(20, " ".join(words))]
    rows += [(100 + i, f"{sentence(rng, 30)} {' '.join(words[:4])} {sentence(rng, 60)}") for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    found = decontaminate.contaminated(documents(rows), items)
    assert sorted(r.doc_id for r in found.collect()) == [*range(15), 20]
    assert decontaminate.drop_contaminated(documents(rows), items).count() == 40


def test_parts_of_long_items_and_edited_short_ones(spark, documents):
    rng = random.Random(9)
    words = [f"i{k}" for k in range(1000)]
    short = {2: "red cats never eat blue fish today", 3: "four plain words here", 4: "every dog has a day"}
    items = spark.createDataFrame([(1, " ".join(words)), *short.items()], "item_id long, text string")
    rows = [
        (1, f"{sentence(rng, 50)} {' '.join(words[200:500])} {sentence(rng, 50)}"), (2, " ".join(words[40:53])), (3, " ".join(words[40:52])),
        (4, f"{sentence(rng, 9)} red cats never drink blue fish today"), (5, "four plain old words here"), (6, "four plain x y z"),
        (7, "every dog had a day"), (8, "every dog has x y"), (9, edited(rng, " ".join(words[100:400]), 0.05)),
        (10, " ".join(w if i % 3 else "x" for i, w in enumerate(words[:120]))), (11, "red cats never"),
        # A dense part stays evidence where a sparse one follows.
        (12, " ".join(w if i < 300 or i % 3 else "x" for i, w in enumerate(words[:600]))),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(rows), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2), (5, 3), (7, 4), (9, 1), (12, 1)}
    assert got[1, 1].score == 0.3 and (got[1, 1].first_word, got[1, 1].end_word) == (50, 350)
    assert round(got[4, 2].score, 2) == 0.79


def test_documents_with_a_stock_phrase_are_not_aligned():
    """200 items and 80 texts share a phrase and nothing else."""
    rng = random.Random(11)
    phrase = "which of the following best describes the main"
    items = [f"{phrase} {' '.join(f'i{rng.randrange(10**6)}' for _ in range(30))}" for _ in range(200)]
    texts = [f"{sentence(rng, 40)} {phrase} {sentence(rng, 40)}".encode() for _ in range(80)]
    index = decontaminate.Index(list(range(200)), [t.encode() for t in items])
    index.choose_seeds(np.full(len(index.grams), 80), 1)
    began = time.perf_counter()
    assert decontaminate.passages(index, texts, index.known(), 0.5) == []
    assert time.perf_counter() - began < 1


@pytest.mark.parametrize("entries, stretch", [(2_000_000, 1 << 20), (50, 60)])
def test_seeds_find_what_aligning_everything_finds(monkeypatch, entries, stretch):
    """Every pair whose best passage holds an n-gram of the item is found, and no other pair is."""
    monkeypatch.setattr(decontaminate, "ENTRIES", entries)
    monkeypatch.setattr(decontaminate, "PAIRS", 7)
    monkeypatch.setattr(decontaminate, "STRETCH", stretch)
    rng = random.Random(12)
    items = [sentence(rng, rng.randrange(4, 60), 60) for _ in range(25)]
    texts = [sentence(rng, rng.randrange(150), 60) for _ in range(40)]
    for item in items:
        for share in (0.0, 0.15, 0.3):
            texts.append(f"{sentence(rng, 15, 60)} {edited(rng, item, share)} {sentence(rng, 15, 60)}")
    texts.append(" ".join(items) * 3)
    index = decontaminate.Index(list(range(len(items))), [t.encode() for t in items])
    index.choose_seeds(np.ones(len(index.grams)), 1)
    found = {hit[:2] for hit in decontaminate.passages(index, [t.encode() for t in texts], index.known(), 0.5)}
    want, seeded = set(), set()
    for i, text in enumerate(texts):
        words = np.array([index.vocabulary.get(w.encode(), 0) for w in text.split()], np.int64)
        for k, item in enumerate(index.items):
            score, first, last = decontaminate.align(item, words)
            if len(words) and (score >= decontaminate._least(len(item), index.n, 0.5) or decontaminate._long(item, words, score)):
                want.add((i, k))
                n = index.n if len(item) >= 2 * index.n else index.short
                grams = {tuple(item[j : j + n]) for j in range(len(item) - n + 1)}
                if any(tuple(words[j : j + n]) in grams for j in range(first, last - n + 1)):
                    seeded.add((i, k))
    assert seeded <= found <= want and len(seeded) > 60


def test_planted_items_are_found_and_clean_documents_left(spark, sf):
    from marketlens.llm.queries import op4_decontamination

    found = {(r.doc_id, r.item_id) for r in op4_decontamination(spark, sf).collect()}
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact <= found

    def flat(text):
        return {w.lower().strip(".,!*#$%&|") for w in text.split()}

    for d, i in found - exact:
        assert len(flat(items[i]) & flat(docs[d])) >= 0.5 * len(flat(items[i]))


# --- mixing ---------------------------------------------------------------------------------------


def test_raked_weights_meet_their_targets(spark):
    rng = random.Random(1)
    cells = [(s, lang, t, rng.randrange(1, 1000)) for s in "abc" for lang in ("en", "de") for t in ("x", "y")]
    table_ = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    aims = {
        "source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.25, "y": 0.75},
    }
    targets = {m: spark.createDataFrame(list(a.items()), "value string, share double") for m, a in aims.items()}
    raked = mixing.rake(table_, targets)
    total = sum(c[3] for c in cells)
    for m, aim in aims.items():
        for r in raked.groupBy(m).agg(F.sum("raked").alias("x")).collect():
            assert abs(r.x / total - aim[r[m]]) < 1e-3
    rated = mixing.probabilities(raked, 0.5 * total).collect()
    assert abs(sum(r.probability * r.tokens for r in rated) - 0.5 * total) < 1e-6 * total
    assert all(0 <= r.probability <= 1 for r in rated)


def test_mix_edges(documents):
    rows = [(i, f"text number {i}", "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None) for i in range(200)]
    rows += [(500, None, "en", "s1"), (501, " ", "de", "s9"), (None, "null key", "en", "s1"), (7, "text number 7", "en", "s3"), (600, LONG, "fr", "s0")]
    docs = documents(rows, tokens="string", row="int", draw="int")
    out = mixing.mix(docs)
    assert out.columns == [*(c for c in docs.columns if c not in mixing.OWN), *mixing.OWN]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.tokens == len(blank_words(r.text)) and (r.sampled is False or r.tokens > 0)
        assert r.topic == ("none" if r.doc_id in (500, 501) else "prose")
    assert len({r.sampled for r in got if r.doc_id == 7}) == 1
    assert mixing.mix(docs.limit(0)).collect() == []


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages_and_result(spark, sf):
    docs = table(spark, sf, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "source_mix"]
    kept, ids = docs, [set(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), docs.schema)
        ids.append({r.doc_id for r in kept.collect()})
        assert ids[-1] <= ids[-2], name
    # Quality rules: what goes is short, repeats itself or is labelled bad; nothing labelled bad stays.
    for i in ids[0] - ids[1]:
        n = len(blank_words(texts[i]))
        assert n < 50 or labels.get(i, 0) == 0 or len(set(blank_words(texts[i]))) < 0.7 * n
    assert all(labels.get(i, 1) == 1 for i in ids[1])
    # Near duplicates: one document of each component.
    rows = sorted((i, texts[i]) for i in ids[1])
    assert ids[2] == {c for _, _, c in brute_components(rows)}
    # Decontamination: no item is left whole, and what goes shares words with one.
    assert not any(x in texts[i] for i in ids[3] for x in items)
    assert {i for i in ids[2] if any(x in texts[i] for x in items)} <= ids[2] - ids[3]
    # Secrets: every row stays, without its secrets.
    assert ids[4] == ids[3]
    for r in kept.collect():
        assert r.n_chars == len(r.text)
        assert not re.search(r"(?i)token = \"[0-9a-f]{20}", r.text)
        if r.text != texts[r.doc_id]:
            assert "[SECRET]" in r.text
    sampled = corpus_pipeline.run(spark, sf)
    assert set(docs.columns) < set(sampled.columns)
    assert {r.doc_id for r in sampled.collect()} <= ids[4]


def test_pipeline_on_empty_and_odd_documents(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")

    def through(docs):
        corpus_pipeline.table, real = lambda s, d, n: items, corpus_pipeline.table
        try:
            for _, stage in corpus_pipeline.STAGES:
                docs = stage(spark, docs, "")
        finally:
            corpus_pipeline.table = real
        return docs

    assert through(documents([]).limit(0)).collect() == []
    rows = [(None, None), (1, ""), (1, ""), (2, " ".join(f"w{i}" for i in range(100)))]
    assert [r.doc_id for r in through(documents(rows, weight="int", row="int")).collect()] in ([2], [])
