"""Secrets, quality rules, main text, language and quality models, archives."""

import base64
import hashlib
import math
import re
import time
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import html, langid, quality, rules, secrets, warc
from marketlens.llm.common import table

LONG = "word " * 60_000


# --- secrets --------------------------------------------------------------------------------------


def brute_base(text):
    """The base spans by walking the patterns' definition."""
    text = text or ""
    found = []
    pattern = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    kinds = ["assign", "access", "hex"]
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))


HEX = "0123456789abcdef" * 2
SECRETS = [
    None, "", " \n", "password: short", "token=secret: longvalue123", f"é PassWord = '{HEX}' AKIAABCDEFGHIJKL12 {HEX}", "AKIAAKIA",
    f"Token=tok token={HEX}", "ſecret=abcdefgh1 api_Key=abcdefgh1", LONG, 'p = "Zx9!kQ2w#Lm7"\ndb_pwd = p\n',
]


def test_secret_base_spans_match_brute_force(documents):
    rows = {r.doc_id: r for r in secrets.find_secrets(documents(list(enumerate(SECRETS)), spans="int", n_hex="string")).collect()}
    assert len(rows) == len(SECRETS)
    for i, text in enumerate(SECRETS):
        want = brute_base(text)
        assert rows[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(want.count(k) for k in ("assign", "access", "hex"))
        assert ",".join(s for s in rows[i].spans.split(",") if not s.startswith("literal")) == want


@pytest.mark.parametrize(
    "text, secret",
    [
        ('p = "Zx9!kQ2w#Lm7"\ndb_pwd = p\n', "Zx9!kQ2w#Lm7"),
        ('config["db_passphrase"] = "Zx9!kQ2w#Lm7"', "Zx9!kQ2w#Lm7"),
        ('{"privateKey": "Zx9!kQ2w#Lm7"}', "Zx9!kQ2w#Lm7"),
        ("<credential>Zx9!kQ2w#Lm7</credential>", "Zx9!kQ2w#Lm7"),
        ("pwd: Zx9!kQ2w#Lm7", "Zx9!kQ2w#Lm7"),
    ],
)
def test_lexed_literals(text, secret):
    found = [text[s.start : s.end] for s in secrets.scan(text.encode()) if s.kind == "literal"]
    assert found == [secret]


@pytest.mark.parametrize("name", ["pass_phrase", "pass-word", "PASS_WORD", "to.ken", "'pass 1 word'", "to\u212aen"])
def test_names_in_parts_are_lexed(name):
    text = f'{name} = "Xk29vbQ7zLw4"'
    assert [text[s.start : s.end] for s in secrets.scan(text.encode())] == ["Xk29vbQ7zLw4"]


def test_long_elements_are_spans():
    value = "Xk29vbQ7" * 200
    text = f"<private_key>{value}</private_key>"
    assert [text[s.start : s.end] for s in secrets.scan(text.encode())] == [value]
    started = time.time()
    assert not secrets.scan(("<token>" + "a " * 20).encode() * 20_000)
    assert time.time() - started < 10


@pytest.mark.parametrize("text", ['password_file = "/etc/Zx9kQ2wLm7"', 'pwd = "changeme-example"', 'pwd = "a plain sentence here"', 'title = "Zx9!kQ2w#Lm7"', "pwd = x"])
def test_harmless_literals(text):
    assert not [s for s in secrets.scan(text.encode()) if s.kind == "literal"]


def test_pieces_of_a_concatenation_are_all_spans():
    text = 'a = "Zx9!kQ"\nclient_pwd = a + "2w#Lm7"'
    assert [text[s.start : s.end] for s in secrets.scan(text.encode())] == ["Zx9!kQ", "2w#Lm7"]


def test_constants_added_to_themselves_cost_their_lines():
    lines = ['a = "Zx9!kQ2w"'] + ["a = a + a"] * 10_000 + ["c = a + 'Lm7#'"] + ["c = c + a"] * 2_000 + ["db_password = c"]
    text = "\n".join(lines)
    began = time.perf_counter()
    assert [text[s.start : s.end] for s in secrets.scan(text.encode())] == ["Zx9!kQ2w", "Lm7#"]
    assert time.perf_counter() - began < 4


@pytest.mark.parametrize("left, right", [("<secr", "et>Ab9#"), ("Ab9#cha", "nge-me"), ("Ab9#xx", "xxQ1"), ("Ab9#dum", "my12"), ("pla", "ceholderA1#")])
def test_placeholders_across_a_joint_are_no_secrets(left, right):
    for text in (f'api_secret = "{left}" + "{right}"', f"p = '{left}'\nq = p + '{right}'\npassphrase = q"):
        assert not [s for s in secrets.scan(text.encode()) if s.kind == "literal"]


def test_literals_are_held_against_nested_base_spans():
    base = [secrets.Span(0, "assign", 50, 10), secrets.Span(12, "access", 30, 12), secrets.Span(60, "hex", 70, 60)]
    text = " " * 52 + 'token_="Zx9!kQ2w"'
    wide = " " * 20 + 'secret="Zx9!kQ2w"'
    assert secrets.lexed_spans(wide, base) == []
    assert [(s.start, s.end) for s in secrets.lexed_spans(text, base[:2])] == [(60, 68)]



def test_redaction_keeps_rows_and_names(documents):
    docs = documents(list(enumerate(SECRETS)))
    out = {r.doc_id: r for r in secrets.redact_secrets(docs).collect()}
    assert len(out) == len(SECRETS) and out[0].text is None and out[9].text == LONG
    assert out[5].text == "é PassWord = '[SECRET]' [SECRET] [SECRET]"
    assert out[10].text == 'p = "[SECRET]"\ndb_pwd = p\n'


# --- quality rules --------------------------------------------------------------------------------


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + d for p in places.values() if len(p) > 1 for i in p for d in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


RULE_TEXTS = [
    None, "", " \n\t ", "a", "a b", "a a a a", "a b c a b c x", "x\n\nx \nx\n", "é ü b c | # & <b>", "a b " * 40, LONG[:50_000],
    "\n".join(f"Line {i} of a clean text with its own words number {i * 7}." for i in range(30)),
    " ".join(f"junk{i}***" for i in range(80)), " ".join(f"SHOUT{i}!!" for i in range(80)),
]


def test_rule_measures_match_brute_force(documents):
    docs = documents([*enumerate(RULE_TEXTS), (None, "a b c"), (3, "a")], n_words="string", row="int", t="int")
    rows = rules.quality_rules(docs).collect()
    assert len(rows) == len(RULE_TEXTS) + 2
    for r in rows:
        text = "a b c" if r.doc_id is None else RULE_TEXTS[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(text), text
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_keep_clean_and_drop_junk(documents):
    clean = [(i, " ".join(f"word{i}x{k} and" for k in range(40))) for i in range(60)]
    junk = [(100 + i, " ".join(f"w{i}x{k}***" for k in range(80))) for i in range(8)]
    docs = documents([*clean, *junk], kept="string")
    assert {r.doc_id for r in rules.keep_good(docs).collect()} == {i for i, _ in clean}
    assert rules.keep_good(docs).columns == docs.columns


def test_rules_on_an_empty_table(documents):
    assert rules.quality_rules(documents([]).limit(0)).collect() == []


# --- main text ------------------------------------------------------------------------------------

WEIGHTS = {"words": 2.0, "outside words": -2.0, "p": -0.1, "div": -0.5}


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<p>a<p>b<br>c", "a b c"),
        ("<nav><a>Home</a></nav><article><h1>T</h1><p>x <b>y</b>z</p></article><footer>f</footer>", "T x yz"),
        ("<div class='ad'>buy<article><p>kept</p></article>", "kept"),
        ("<article><p>one</p><div class='post-comments'><p>me too</p></div><form>mail</form><p>two</p></article>", "one two"),
        ("<article><p>a &lt;b&gt; c</p><script>var x = '</p>';</script><!-- no --><p>cut &eacute;</p><p cla", "a <b> c cut é"),
        ("<div id=content-with-sidebar><p>main words here</p><div class=sidebar>side</div></div>", "main words here"),
        ("<header>Site</header><p>long enough main text of the page</p><aside>other</aside>", "long enough main text of the page"),
        ("<b>un</i>closed</p> text < 3", "unclosed text < 3"),
        ("<title>T</title><p>a<STYLE>x</STYLE >b <select><option>o</select> c<br>d <button>e", "ab c d e"),
        ("<p>a</p><script>left open <p>b</p>", "a"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page, WEIGHTS) == text


def test_main_text_is_linear_in_what_is_left_open():
    for piece in ("<button>", "<select>x", "<![CDATA[", "<a title=\"", "<p>", "<div>", "</div>", "<!--", "<"):
        assert len(html.main_text(piece * 20_000, WEIGHTS)) >= 0


@pytest.mark.parametrize("block", ['div class="legal-news"', 'div class="discussion-paper"', 'div id="social"', 'div class="modal"><div class="alert-text"'])
def test_a_story_in_a_block_with_a_telling_name_is_read(block):
    story = " ".join(f"word{i}" for i in range(200))
    page = f"<html><head><title>A</title></head><body><nav><a>Home</a> <a>News</a></nav><h1>Heading</h1><{block}><p>{story}</p></div><footer>f g</footer>"
    assert story in html.main_text(page, WEIGHTS) and "Home" not in html.main_text(page, WEIGHTS)
    seen = WEIGHTS | {f"in {m}": html.LEAST_TRUST for m in ("social", "legal", "alert", "discussion")}
    assert story in html.main_text(page, seen)


def test_long_comments_beside_a_story_stay_out():
    story, comment = " ".join(f"word{i}" for i in range(200)), "<p>" + "me too " * 100 + "</p>"
    page = f"<div><p>{story}</p></div><div class=comments>{comment * 8}</div>"
    assert html.main_text(page, WEIGHTS) == story
    assert html.main_text("<nav>" + "<a>Home</a> <a>News</a>" * 20 + "</nav><article></article>", WEIGHTS) == ""


def test_nested_tags_are_linear():
    for page in ("<div>" * 40_000 + "</span>" * 40_000, "<b>" * 40_000 + "<p>" * 40_000, "<nav>" * 20_000 + "x</nav>" * 20_000, "<b><div>" * 20_000 + "</b>" * 20_000):
        began = time.perf_counter()
        html.main_text(page, WEIGHTS)
        assert time.perf_counter() - began < 3


def test_pages_match_their_articles(spark, sf):
    pages = table(spark, sf, "pages")
    got = {r.page_id: r for r in html.extract_text(pages).collect()}
    for r in pages.collect():
        inner = r.html[r.html.find("<article>") + 9 :].partition("</article>")[0]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", "\0", inner)).split("\0")
        want = " ".join(b for b in (re.sub(r"\s+", " ", unescape(x)).strip() for x in blocks) if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_main_text_without_and_with_other_articles(spark, sf):
    pages = table(spark, sf, "pages")
    weights = html.fit_weights(pages)
    teasers = "".join(f"<article><h2><a href='/{i}'>Story {i} of the day</a></h2><p>A short line that leads on.</p></article>" for i in range(5))
    for r in pages.collect():
        want = html.main_text(r.html, weights)
        plain = re.sub("<(/?)article[^>]*>", r"<\1div>", r.html)
        assert html.main_text(plain, weights) == want
        assert html.main_text(re.sub("</?article[^>]*>", "", r.html), weights) == want
        if len(want.split()) > 60:
            at = r.html.find("<article")
            assert html.main_text(plain[:at] + teasers + plain[at:], weights) == want


def test_pages_with_nulls_and_repeats(spark):
    rows = [(None, None, None), (1, "u", ""), (2, "u", LONG), (2, "u", LONG), (3, None, "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("kind", F.lit(2))
    got = sorted((r.page_id or 0, r.url, r.n_chars) for r in html.extract_text(pages).collect())
    assert got == [(0, None, 0), (1, "u", 0), (2, "u", len(LONG) - 1), (2, "u", len(LONG) - 1), (3, None, 1)]
    assert html.extract_text(pages.limit(0)).collect() == []


# --- language -------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark, larger):
    from marketlens.llm.queries import op2_language_id

    got = {r.doc_id: r for r in op2_language_id(spark, larger).collect()}
    docs = table(spark, larger, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        assert 0 <= got[d.doc_id].score <= 1
    held = [got[d.doc_id].lang_pred == d.lang for d in docs if got[d.doc_id].held_out]
    assert sum(held) >= 0.97 * len(held)


def test_language_edges(documents):
    docs = documents([(1, "the cat and the dog", "en", "s"), (2, "der hund und die katze", "de", "s")])
    prototypes = langid.fit_prototypes(docs, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the dog"), (4, "the dog"), (None, "DIE KATZE"), (6, "der hund " * 30_000)]
    out = langid.predict_language(documents(rows, score="int", lang_pred="int"), prototypes).collect()
    got = sorted(((r.doc_id or 0), r.lang_pred) for r in out)
    assert got == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (6, "de")]
    assert {r.score for r in out if r.lang_pred == "und"} == {0.0}
    assert {r.lang_pred for r in langid.predict_language(documents(rows), {}).collect()} == {"und"}
    assert langid.fit_prototypes(docs.limit(0), F.lit(True)) == {}
    assert langid.predict_language(documents([]).limit(0), prototypes).collect() == []


def test_language_prediction_does_not_read_labels(spark, documents):
    docs = documents([(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "s") for i in range(10)])
    prototypes = langid.fit_prototypes(docs, F.lit(True))
    swapped = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert sorted(langid.predict_language(docs, prototypes).collect()) == sorted(langid.predict_language(swapped, prototypes).collect())


# --- quality model --------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark, larger):
    from marketlens.llm.queries import op6_quality_classifier

    got = {r.doc_id: r for r in op6_quality_classifier(spark, larger).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, larger, "labels").collect()}
    assert len(got) == table(spark, larger, "documents").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [got[i].predicted == q for i, q in labels.items() if got[i].held_out]
    assert sum(held) >= 0.97 * len(held)


def test_quality_rows_of_shapes_are_found_once(monkeypatch):
    """Words of equal kinds of letters share one look-up, and every word has the rows that it has by itself."""
    asked, own = [], quality._shape_row
    monkeypatch.setattr(quality, "_shape_row", lambda letters: asked.append(letters) or own(letters))
    words = [w.encode() for i in range(300) for w in (f"wort{100 + i}", f"Wort{100 + i},", "ÄÖ")]
    codes = quality.Rows().of(words)
    assert sorted(asked) == sorted({b"aaaa000", b"Aaaa000,", b"aaaa"})
    assert [(c & quality._LOW, c >> 32) for c in codes.tolist()] == [quality.rows_of(w) for w in words]


def test_quality_edges(spark, documents):
    rows = [(i, f"good plain words {i} here and there") for i in range(20)] + [(20 + i, f"BAD{i}!! ###") for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(40, None), (None, 1)], "doc_id long, quality int")
    docs = documents([*rows, (40, None), (41, ""), (41, ""), (None, LONG)], score="int", predicted="string")
    model = quality.fit_model(docs, labels, F.lit(True))
    out = quality.score_quality(docs, model).collect()
    assert len(out) == 44 and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.doc_id < 20) for r in out if r.doc_id is not None and r.doc_id < 40)
    assert len({r.score for r in out if r.doc_id == 41}) == 1
    none = quality.fit_model(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).collect() == []


def test_word_vectors_equal_brute_force(spark, documents, monkeypatch):
    data = ["the Cat sat\nthe cat", "x", "", "A1 b2 A1 b2 c3 " * 40, None]
    sums = np.zeros((quality.WORD_ROWS + quality.SHAPE_ROWS, quality.DIMENSIONS))
    index = quality.index_vectors()
    for text in data:
        rows = [quality.rows_of(w) for w in (text or "").encode().split()]
        for i, own in enumerate(rows):
            for j in range(max(0, i - quality.WINDOW), min(len(rows), i + quality.WINDOW + 1)):
                if i != j:
                    for row in own:
                        sums[row] += index[rows[j][0]] + index[rows[j][1]]
    want = quality.vectors_of(sums)
    docs = documents(list(enumerate(data)))
    assert np.allclose(quality.fit_vectors(docs).vectors, want, atol=1e-6)
    assert (quality.fit_vectors(docs).vectors == quality.fit_vectors(docs.coalesce(1)).vectors).all()
    for chunk in (1, 7):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        pieces = np.zeros_like(sums, dtype=np.int64)
        for text in data:
            quality.add_contexts(pieces, quality.Rows().of((text or "").encode().split()))
        assert (pieces == sums).all()


def test_pooled_vectors_and_scores_equal_brute_force(spark, documents):
    data = ["the Cat sat on the mat", "", None, "BAD!! ### x9", "plain words here"]
    docs = documents(list(enumerate(data)))
    model = quality.fit_model(docs, spark.createDataFrame([(0, 1), (3, 0)], "doc_id long, quality int"), F.lit(True))
    x = np.zeros((len(data), 2 * quality.DIMENSIONS + 2))
    for i, text in enumerate(data):
        words = (text or "").encode().split()
        for w in words:
            for side, row in enumerate(quality.rows_of(w)):
                x[i, side * quality.DIMENSIONS : (side + 1) * quality.DIMENSIONS] += model.vectors[row] / len(words)
        if words:
            x[i, -2:] = math.log1p(len(words)), len(set(words)) / len(words)
    want = model.probabilities(x)
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert all(abs(got[i].score - want[i]) < 1e-5 and got[i].predicted == int(got[i].score >= 0.5) for i in range(len(data)))


def test_a_very_long_text_leaves_the_other_labelled_rows_in(spark, documents):
    rows = [(i, f"good plain words {i} here and there") for i in range(20)] + [(20 + i, f"BAD{i}!! ###") for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(41)], "doc_id long, quality int")
    model = quality.fit_model(documents([*rows, (40, "#### " * 4_000_000)]), labels, F.lit(True))
    assert all(r.predicted == int(r.doc_id < 20) for r in quality.score_quality(documents(rows), model).collect())


# --- archives -------------------------------------------------------------------------------------


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "u\r\nx", None), (5, "u", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n\r\n"),
    (7, "u", LONG), (8, "u", "alone"), (8, "u", "alone"),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("digest", F.lit(1))
    got = sorted(tuple(r) for r in warc.round_trip(pages).collect())
    best = {}
    for i, _, h in PAGES:
        best[h or ""] = max(i, best.get(h or "", 0))
    want = sorted(
        (i, len((h or "").encode()), sha((h or "").encode()), "response" if best[h or ""] == i else "revisit") for i, _, h in PAGES
    )
    assert [g[:4] for g in got] == want
    assert {g[0]: g[4] for g in got} == {i: None if best[h or ""] == i else best[h or ""] for i, _, h in PAGES}


def test_small_payloads_may_stay_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.round_trip(pages, least=5).collect()}
    assert kinds[1] == kinds[2] == kinds[4] == kinds[5] == "response"


def test_archives_push_predicates_down_and_skip_payloads(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_warc(pages, path)
    found = warc.read_warc(spark, path)
    assert found.count() == len(PAGES)
    again = warc.read_warc(spark, path, where={"record_type": ["revisit"]})
    assert sorted(r.target_uri for r in again.collect()) == ["http://a/1", "http://a/2", "ux"]
    one = warc.read_warc(spark, path, where={"record_id": ["<urn:page:3>", "none"], "record_type": ["response"]})
    assert [r.payload for r in one.collect()] == [b"same"]
    assert warc.read_warc(spark, path, where={"record_type": []}).collect() == []
    with pytest.raises(ValueError):
        warc.read_warc(spark, path, where={"payload": ["x"]})
    light = warc.read_warc(spark, path, payload=False)
    assert {r.payload for r in light.collect()} == {None}
    assert light.agg(F.sum("payload_bytes")).first()[0] == found.agg(F.sum("payload_bytes")).first()[0]
    warc.write_warc(pages.limit(0), path + "0")
    assert warc.read_warc(spark, path + "0").collect() == []


def test_the_round_trip_skips_what_it_does_not_need(spark, monkeypatch):
    asked, read = [], warc.read_warc

    def noted(spark, path, payload=True, where=None):
        asked.append((payload, where))
        return read(spark, path, payload, where)

    monkeypatch.setattr(warc, "read_warc", noted)
    pages = spark.createDataFrame([(1, "u", "<p>x"), (2, "u", "<p>x"), (3, "v", None)], "page_id long, url string, html string")
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect())
    assert got == [(1, "revisit", 2, 4), (2, "response", None, 4), (3, "response", None, 0)]
    assert asked == [(True, {"record_type": ["response"]}), (False, {"record_type": ["revisit"]})]


def test_skipping_does_not_lose_the_place():
    import io

    data = b"".join(f"WARC/1.1\r\nWARC-Type: {t}\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n".encode() for t, b in [("a", "x" * 9), ("b", ""), ("a", "\r\n\r\n")])
    assert [r[-1] for r in warc.records(io.BytesIO(data), {"record_type": {"a"}}, True)] == [b"x" * 9, b"\r\n\r\n"]
    assert [r[0] for r in warc.records(io.BytesIO(data), {}, False)] == ["a", "b", "a"]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data[:-6]), {}, True))
