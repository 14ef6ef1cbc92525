"""Language mixtures, page extraction and lattice scores."""

import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import lattice_lm
from corpusloom.llm.crf_extract import _marginals, decode, extract_text, features, main_text, train
from corpusloom.llm.labelled_pages import labelled_pages
from corpusloom.llm.lattice import Lattice, Vocabulary
from corpusloom.llm.lattice_lm import score_texts
from corpusloom.llm.leaf_blocks import leaf_blocks
from corpusloom.llm.mixture_langid import fold, learn, predict, proportions

PIECES = public_tokenizers.path("piece_bpe_32k.model")
EN = "the of and that with this from have which their there would about into other".split()
DE = "der und nicht sich auch eine wird über können zwischen müssen straße für bei schon".split()
FR = "les des est une dans que pour qui avec été être même après où très".split()


def text_in(words, n, draw):
    return " ".join(draw.choice(words) for _ in range(n))


def test_languages_held_out_and_mixed(spark):
    draw = random.Random(6)
    rows = []
    for i in range(240):
        lang, words = (("en", EN), ("de", DE), ("fr", FR))[i % 3]
        rows.append((i, text_in(words, draw.randint(3, 80), draw), lang if i % 7 else None))
    rows += [(900, text_in(EN, 120, draw) + " " + text_in(FR, 40, draw), None), (901, None, "en"), (902, "123 …", "de"), (903, "", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    langs, model = learn(df.where(fold("doc_id", 3) != 1))
    assert langs == ["de", "en", "fr"] and np.allclose(np.exp(model).sum(axis=1), 1)
    got = {r.doc_id: r for r in predict(df, langs, model, carry=["doc_id"]).collect()}
    assert all(got[i].lang_pred == ("en", "de", "fr")[i % 3] and 0 <= got[i].score <= 1 for i in range(240))
    assert set(got[900].lang_shares) == {"en", "fr"} and 0.6 < got[900].score < 0.9 and got[900].lang_pred == "en"
    assert abs(sum(got[900].lang_shares.values()) - 1) < 1e-9
    for i in (901, 902, 903):
        assert (got[i].lang_pred, got[i].score, got[i].lang_shares) == ("und", 0.0, {})


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    langs, model = learn(df)
    assert langs == [] and [r.lang_pred for r in predict(df, langs, model).collect()] == ["und"]
    assert predict(df.limit(0), langs, model).collect() == []


def test_proportions_find_the_likelihoods_top():
    draw = np.random.default_rng(1)
    model = np.log(draw.dirichlet(np.full(60, 0.1), 4) + 1e-9)
    truth = np.array([0.6, 0.0, 0.4, 0.0])
    counts = draw.multinomial(4000, truth @ np.exp(model) / (truth @ np.exp(model)).sum()).astype(float)
    assert np.allclose(proportions(counts, model), truth, atol=0.05)
    alone = draw.multinomial(4000, np.exp(model[1]) / np.exp(model[1]).sum()).astype(float)
    assert proportions(alone, model).tolist() == [0, 1, 0, 0]


def test_fold_is_crc32_of_the_text(spark):
    got = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_leaf_blocks_of_broken_pages():
    page = ("<title>no</title><p>a &amp; b &lt;x&gt;&nbsp; c<br>d<script>if(a<b)</script> e<li>x<li>y<ul><li>z</ul>t < 5<div hidden>no</div>"
            "<table><tr><td>1<td>2<tr><td>3</table></p>tail<svg><text>no</svg>ok<!-- no --><p class='x y' id=q>zz &#39;&eacute;&copy; <b>u<p>v</b> w <unclosed")
    assert [b.text for b in leaf_blocks(page)] == ["a & b <x> c d e", "x", "y", "z", "t < 5", "1", "2", "3", "tail ok", "zz 'é© u", "v w"] or \
        [b.text for b in leaf_blocks(page)] == ["a & b <x> c d e", "x", "y", "z", "t < 5", "1", "2", "3", "tailok", "zz 'é© u", "v w"]
    for broken in (None, "", "<", "</", "<!", "<!--", "<p", "<p class=", "<p class='", "</p>", "a<b", "<script>", "<<<>>>", "&#xFFFFFFF;&"):
        leaf_blocks(broken)
    assert leaf_blocks("<div>" * 5000 + "deep")[0].text == "deep"


def test_deep_pages_take_linear_time():
    deep = 100_000
    for page in ("<div class=post>x" * deep, "<ul><li><ul>" + "<div>" * deep + "<li>y</li>" * deep, "<p>" + "<b>" * deep + "x<i>y</i>" * deep,
                 "".join(f"<x{i}>t" for i in range(deep)), "<b>" * deep + "<p>z</p>" * deep, "<table>" + "<tr><td>q" * deep):
        start = time.process_time()
        blocks = leaf_blocks(page)
        assert all(features(b) for b in blocks) and blocks
        assert time.process_time() - start < 40


def test_text_of_formulas_and_fallbacks_stays():
    page = "<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is <audio src=x>a sound</audio> known.</p><object><p>inside</p></object>"
    assert [b.text for b in leaf_blocks(page)] == ["Energy E=m is a sound known.", "inside"]


BY_HAND = [
    ("""<html><head><title>T</title></head><body><div id="nav"><ul><li><a href=/>Home</a><li><a href=/b>About us</a></ul></div>
        <div class="post-content"><h1>How rivers bend</h1><p>A river that meets soft ground cuts its outer bank and leaves sand on the inner one, so the bend grows with every flood.</p>
        <p>After some hundred years the neck between two bends is cut through, &amp; a lake is left behind.</p></div>
        <div class="comments"><p>Anna: nice read, thank you so much for this!</p></div><div class="footer">© 2020 All rights reserved</div></body></html>""",
     ["How rivers bend", "A river that meets", "After some hundred"], ["Home", "About us", "Anna", "rights"]),
    ("""<body><header><a href="/">The Daily</a></header><main><article><h2>Bread prices</h2><p>Bakers in the valley raised their prices for the third time this year, as flour became scarce.
        <p>One of them said that <a href=x>no end</a> was in sight.</article></main><aside class=sidebar><h3>Most read</h3><a href=1>Ten ways to sleep well</a></aside>
        <footer><p>Contact | Imprint</p></footer>""",
     ["Bakers in the valley", "no end was in sight"], ["Ten ways", "Imprint"]),
]


@pytest.mark.parametrize("page, inside, outside", BY_HAND)
def test_pages_written_by_hand(page, inside, outside):
    text = main_text(page, train())
    assert all(t in text for t in inside) and not any(t in text for t in outside)


@pytest.mark.parametrize("tag", ["script", "style", "noscript", "title"])
def test_raw_elements_end_in_any_case_beside_letters_that_fold_longer(tag):
    page = f"<p>\u0130stanbul</p><{tag}>a < b \u0130</{tag.upper()}><p>article</p><{tag}>c</{tag.title()}><p>end</p>"
    assert [b.text for b in leaf_blocks(page)] == ["\u0130stanbul", "article", "end"]


def test_marginals_and_viterbi_by_enumeration():
    draw = random.Random(2)
    for n in (1, 2, 5):
        score, t = [draw.uniform(-2, 2) for _ in range(n)], [draw.uniform(-1, 1) for _ in range(4)]
        total, inner, best = 0.0, [0.0] * n, (-math.inf, None)
        for y in itertools.product((0, 1), repeat=n):
            value = sum(s for s, on in zip(score, y) if on) + sum(t[2 * a + b] for a, b in zip(y, y[1:]))
            total += math.exp(value)
            best = max(best, (value, y))
            for i in range(n):
                inner[i] += math.exp(value) * y[i]
        got, moves = _marginals(score, t)
        assert np.allclose(got, [x / total for x in inner]) and abs(sum(moves) - (n - 1)) < 1e-9
        assert tuple(decode(score, t)) == best[1]
    assert decode([], [0.0] * 4) == []


def test_held_out_pages():
    weights, t = model = train()
    wrong = blocks = 0
    for page, labels in labelled_pages(200, 12345):
        found = leaf_blocks(page)
        text = main_text(page, model)
        expected = "\n".join(b.text for b, y in zip(found, labels) if y)
        wrong += text != expected
        blocks += len(found)
    assert wrong <= 4 and blocks > 2000


def test_extract_rows(spark):
    article = "<article><h1>Head line</h1><p>First   part &amp; more, of it.<p>Second part.</article>"
    page = f"<body><nav><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></nav><div class=ad>Buy this now.</div>{article}<footer>© me</footer>"
    df = spark.createDataFrame([(1, page, "x"), (2, None, "x"), (3, "", "x"), (4, page, "x"), (5, "<article>" + "<p>Some words that go on, and on.</p>" * 4000 + "</article>", "x")],
                               "page_id long, html string, text string")
    got = {r.page_id: r.text for r in extract_text(df, carry=["page_id"]).collect()}
    assert got[1] == got[4] == "Head line\nFirst part & more, of it.\nSecond part."
    assert got[2] == got[3] == "" and got[5] == "\n".join(["Some words that go on, and on."] * 4000)
    assert extract_text(df.limit(0)).collect() == []
    assert "in nav" in features(leaf_blocks(page)[0])


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PIECES)


def brute(lattice, word):
    """Sum over all ways to cut, and the expected uses, by recursion over the first piece."""
    text = "▁" + word
    pieces = {p: lattice.arcs[p] for p in lattice.vocabulary.ids}
    ways = []

    def go(at, log, used):
        if at == len(text):
            ways.append((log, used))
            return
        for stop in range(at + 1, len(text) + 1):
            part = text[at:stop]
            if part in pieces:
                go(stop, log + pieces[part], used + [lattice.vocabulary.ids[part]])
        if text[at] not in pieces:
            own = [lattice.vocabulary.byte_ids[b] for b in text[at].encode()]
            go(at + 1, log + sum(lattice.bytes[b] for b in text[at].encode()), used + own)

    go(0, 0.0, [])
    return ways


def test_lattice_by_enumeration(vocabulary):
    lattice = Lattice(vocabulary, vocabulary.prior)
    assert abs(math.fsum(vocabulary.prior) - 1) < 1e-9 and min(vocabulary.prior[i] for i in vocabulary.ids.values()) > 0
    for word in ("the", "thstinnt", "x", "漢字", "\U00012345q", "naïve", ""):
        ways = brute(lattice, word)
        total = math.fsum(math.exp(w) for w, _ in ways)
        assert math.isclose(lattice.log_probability(word), math.log(total), rel_tol=1e-9), word
        uses = lattice.expect([(word, 3)])
        expected = Counter()
        for log, used in ways:
            for piece in used:
                expected[piece] += 3 * math.exp(log) / total
        assert all(math.isclose(uses[i], n, rel_tol=1e-6, abs_tol=1e-9) for i, n in expected.items())
        assert math.isclose(sum(uses), sum(expected.values()), rel_tol=1e-6)


def test_many_words_are_as_one_by_one(vocabulary):
    draw = random.Random(12)
    lattice = Lattice(vocabulary, vocabulary.prior)
    words = ["".join(draw.choice("theandingsßé漢x▁😀") for _ in range(draw.randint(0, 45))) for _ in range(400)]
    assert np.allclose(lattice.log_probabilities(words), [lattice.log_probability(w) for w in words], rtol=1e-12)
    times = [draw.randint(1, 9) for _ in words]
    assert np.allclose(lattice.expect_many(words, times), lattice.expect(zip(words, times)), rtol=1e-6, atol=1e-9)


def test_a_very_long_word_has_a_finite_score(vocabulary):
    assert -math.inf < Lattice(vocabulary, vocabulary.prior).log_probability("ab" * 5000) < -1000


@pytest.mark.parametrize("head", [0, 5, 100_000])
def test_scores_by_hand(spark, monkeypatch, vocabulary, head):
    monkeypatch.setattr(lattice_lm, "HEAD_WORDS", head)
    draw = random.Random(9)
    words = ["the", "The", "tree", "x" * 60, "é", "rarely", "fox", "ÀB"]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t "), (1, rows[1][1]), (103, "unseen\x1cword neverthere")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    learns = fold("doc_id", 5) != 1
    got = score_texts(df, PIECES, learns, carry=["doc_id"], rounds=1).collect()
    lower = [(i, (t or "").encode().lower().decode()) for i, t in rows]
    split = [(i, [w for w in t.replace("\t", " ").split(" ") if w]) for i, t in lower]
    counts = Counter()
    for i, own in split:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(own + [None])
    n, v = sum(counts.values()), len(counts)
    uses = np.array(Lattice(vocabulary, vocabulary.prior).expect([(w, c) for w, c in counts.items() if w is not None]))
    uses[-1] = counts[None]
    uses += lattice_lm.PRIOR_USES * len(uses) * np.array(vocabulary.prior)
    lattice = Lattice(vocabulary, (uses / uses.sum()).tolist())
    expected = sorted((i, len(own) + 1, sum(counts[w] > 0 for w in own + [None]), n,
                       round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own + [None]), 6),
                       round((sum(lattice.log_probability(w) for w in own) + lattice.log_end) / math.log(10), 6)) for i, own in split)
    mine = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert len(mine) == len(expected)
    for a, b in zip(mine, expected):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], abs_tol=1e-5) and math.isclose(a[5], b[5], abs_tol=1e-5)


def test_scores_without_learning(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = score_texts(df, PIECES, F.lit(False), carry=["doc_id"]).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == 0.0 and row.score < 0
    assert score_texts(df.limit(0), PIECES, F.lit(True)).collect() == []
