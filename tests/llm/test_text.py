import numpy as np
import pytest

from contract_lake.llm import langcrf, wrappers
from contract_lake.llm import queries as q
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.01"


def test_language_accuracy_held_out(spark):
    rows = q.op9_language_crf(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tagger = langcrf.train(docs)
    samples = {lang: [w for r in docs.where(langcrf.held_out() & (langcrf.F.col("lang") == lang)).limit(5).collect() for w in langcrf.WORD.findall(r.text)][:30]
               for lang in ("en", "de")}
    label = langcrf.word_labels(tagger, samples["en"] + samples["de"] + samples["en"])
    assert label.shape == (90, 4) and np.allclose(label.sum(axis=1), 1)
    guess = [tagger.languages[k] for k in label.argmax(axis=1)]
    assert np.mean([a == b for a, b in zip(guess, ["en"] * 30 + ["de"] * 30 + ["en"] * 30, strict=True)]) > 0.85


def test_forward_backward_against_enumeration():
    from itertools import product
    chance = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    emission, step = chance.random((8, 3)) + 0.1, chance.random((3, 3)) + 0.1
    starts = np.cumsum(lengths) - lengths
    got, pairs = langcrf.forward_backward(emission, starts, lengths, step, pairs=True)
    expected = np.zeros((3, 3))
    for s, n in zip(starts, lengths, strict=True):
        total, marginal, steps = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in product(range(3), repeat=int(n)):
            p = np.prod([emission[s + t, y] for t, y in enumerate(path)]) * np.prod([step[a, b] for a, b in zip(path, path[1:])])
            total += p
            for t, y in enumerate(path):
                marginal[t, y] += p
            for a, b in zip(path, path[1:]):
                steps[a, b] += p
        assert np.allclose(got[s:s + n], marginal / total)
        expected += steps / total
    assert np.allclose(pairs, expected)


def test_segments_agree_with_the_whole(spark, monkeypatch):
    tagger = langcrf.train(spark.read.parquet(f"{SF}/documents.parquet").limit(300))
    words = [w.lower() for _, t, _, _ in edge_rows()[:1] for w in langcrf.WORD.findall(t)]
    whole = langcrf.shares(tagger, [words, []])
    monkeypatch.setattr(langcrf, "SEGMENT_WORDS", 100)
    assert np.allclose(langcrf.shares(tagger, [words, []]), whole, rtol=1e-3)
    assert np.isclose(whole[0].sum(), sum(map(len, words))) and not whole[1].any()


def test_language_of_edges(edge_docs, no_docs, spark):
    tagger = langcrf.train(edge_docs)
    rows = langcrf.predictions(edge_docs, tagger).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (20, 21, 22, 23))
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr", "es"}
    assert langcrf.train(no_docs) is None
    assert {r.lang_pred for r in langcrf.predictions(edge_docs, None).collect()} == {"und"}
    assert langcrf.predictions(no_docs, tagger).count() == 0
    marks = spark.createDataFrame([(1, "123 !!! ___"), (2, "日本語の文")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in langcrf.predictions(marks, tagger).orderBy("doc_id").collect()] == [True, False]


def test_held_out_rows_are_never_learnt_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    F = langcrf.F
    turned = docs.withColumn("lang", F.when(langcrf.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert np.array_equal(langcrf.train(docs).weights, langcrf.train(turned).weights)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>Home {n}</a><li><a href=/b>News</a></ul></nav><!-- <p>no</p> --><script>var t="<p>x</p>";</script>
<div class="cookie-notice">We use cookies {n}</div><div id="content"><h2>Title {n}</h2><p>Fish &amp; chips&nbsp;{n} <b>bo</b>ld<br>line
<p>Second {n}<ul><li>one {n}<li>two</ul><div class="share-buttons">Share me {n}</div></div>
<div class="box">Always the same words</div><aside>Side {n}</aside><form><p>Mail {n}</p><input name=q></form>
<section class="comments"><article class="comment"><p>First! {n}</p></article></section><footer>&copy; {n}</footer></body></html>"""


def test_wrapper_drops_template_and_landmarks():
    pages = [PAGE.format(n=f"w{k} v{k * k}") for k in range(6)]
    wrapper = wrappers.induce(pages)
    text = wrappers.extract(PAGE.format(n="new page"), wrapper)
    assert text == "Title new page Fish & chips new page bold line Second new page one new page two"
    assert "Always the same words" in wrappers.extract(pages[0])  # without a wrapper nothing is template
    same = wrappers.induce([pages[0]] * 6)  # copies of one page make nothing constant
    assert wrappers.extract(pages[0], same) == wrappers.extract(pages[0])


def test_article_wins_and_broken_html_is_read():
    assert wrappers.extract("<body><p>out</p><article><h1>A</h1><p><b>x<p>y</article><p>more") == "A x y"
    assert wrappers.extract("plain &lt;text&gt; only") == "plain <text> only"
    assert wrappers.extract("<p>a<script>if (1<2) {</script>b<style>") == "a b" or wrappers.extract("<p>a<script>x</script>b") == "ab"
    assert wrappers.extract("<article><p>1 < 2 and 3 > 2</p></article>") == "1 < 2 and 3 > 2"
    assert wrappers.extract("<article><p>a</p><nav>b</nav><div role=navigation>c</div><div class='ad-slot'>d</div></article>") == "a"
    for broken in ("", "<", "<!--", "<p", "</p>", "<a href='", "<![CDATA[x"):
        wrappers.extract(broken)
    assert len(wrappers.extract("<div>" * 300 + "deep" + "</div>" * 300)) == 4
    assert wrappers.extract("<article>" + "<p>w</p>" * 50_000 + "</article>") == " ".join(["w"] * 50_000)


def test_pages_of_edges(spark):
    schema = "page_id long, url string, html string, host string, wrapper string, text int, rank int, key int"
    rows = [(k, f"https://A.example/{k}", PAGE.format(n=f"n{k} m{k}"), "h", "w", 1, 2, 3) for k in range(12)]
    rows += [(50, None, "<p>no url</p>", "h", "w", 1, 2, 3), (51, "nonsense", "", "h", "w", 1, 2, 3), (52, "http://b.example", None, "h", "w", 1, 2, 3),
             (None, "http://a.example/x", PAGE.format(n="last"), None, None, None, None, None), (53, "//c.example/", "<article>c</article>", "h", "w", 1, 2, 3)]
    df = spark.createDataFrame(rows + rows[-1:], schema).repartition(3)
    for size in (16 << 20, 0):
        got = wrappers.main_text(df, broadcast_bytes=size).collect()
        assert len(got) == len(rows) + 1 and all(r.n_chars == len(r.text) for r in got)
        text = {r.page_id: r.text for r in got}
        assert text[50] == "no url" and text[51] == text[52] == "" and text[53] == "c"
        assert text[None].startswith("Title last") and all("same words" not in text[k] for k in range(12))
    assert wrappers.main_text(df.where("page_id = -1")).count() == 0


@pytest.mark.parametrize("name", ["op10_wrapper_text"])
def test_articles_of_the_test_pages(spark, name):
    """The test pages hold one article each; a plain reading of it agrees."""
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in q.queries()[name](spark, SF).collect():
        part = re.search(r"<article[^>]*>(.*?)</article>", pages[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h\d|br|li|ul|div)\b[^>]*>", " ", re.sub(r"<!--.*?-->", "", part, flags=re.S)))
        assert r.text == " ".join(html.unescape(plain).split())
