"""Language identification and main text extraction."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from refinery.llm import html_main as H
from refinery.llm import language as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs, L.train_on_open_part(docs), carry={"lang": F.col("lang"), "held_out": L.held_out()})
    unseen = [r for r in out.collect() if r["held_out"]]
    assert len(unseen) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in unseen]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in unseen)


def test_awkward_rows(awkward):
    rows, df = awkward
    model = L.train_on_open_part(df)
    out = L.identify(df, model, carry={"doc_id": F.col("doc_id"), "text": F.col("text"), "row": F.col("row")}).collect()
    assert len(out) == len(rows)
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
        assert r["lang_pred"] in {"en", "de", "fr", "und"}


def test_no_labels_and_no_rows(spark, nothing):
    assert L.train(nothing) is None
    some = spark.createDataFrame([(1, "some text", None, "s")], nothing.schema)
    assert L.train(some) is None and L.identify(some, None).first()["lang_pred"] == "und"
    assert L.identify(nothing, None).count() == 0


def test_prediction_uses_the_text_only(spark):
    en, fr = "the of and this that with from have been were which their would there", "le la les des une pour dans que qui avec sur est pas plus"
    rows = [(i, (en, fr)[i % 2] + f" {'abc'[i % 3]}", ("en", "fr")[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    flipped = L.identify(df.withColumn("lang", F.lit("en")).withColumn("doc_id", F.lit(0)), model, carry={"text": F.col("text")}).collect()
    assert all((r["lang_pred"] == "en") == r["text"].startswith("the") for r in flipped)


def test_one_language_and_unlisted_languages(spark):
    df = spark.createDataFrame([(i, "abc def ghi", "xx") for i in range(30)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in L.identify(df, L.train(df)).collect()} == {"xx"}


def test_sample_is_bounded(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"))
    counted = []
    whole = L.Model.fit
    try:
        L.Model.fit = classmethod(lambda cls, x, lang, families: counted.append(len(x)) or whole(x, lang, families))
        L.train(df, per_language=50)
    finally:
        L.Model.fit = whole
    assert 20 <= counted[0] <= 100


def test_features_do_not_cross_texts_and_cover_all_of_them():
    one, two = b"xyz" * 10, b"abc" * 1000 + b"qqq"
    offsets = np.array([0, len(one), len(one) + len(two)])
    x = L.features(np.frombuffer(one + two, np.uint8), offsets)
    assert np.allclose(x[0], L.features(np.frombuffer(one, np.uint8), np.array([0, len(one)]))[0])
    cut = L.features(np.frombuffer(two[:-3], np.uint8), np.array([0, len(two) - 3]))[0]
    assert not np.allclose(x[1], cut)


# --- main text -----------------------------------------------------------------------------------

PROSE = "Plain words of the story go on and on, with more to say in every line of it. " * 4
CHROME = ('<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>',
          '<div class="ad-box ad">Buy things now</div><aside>See also <a href="#">this</a></aside>',
          '<footer>Copyright &copy; site</footer><script>var a = "<p>no</p>";</script>')


@pytest.mark.parametrize("body", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "{}"])
def test_article_without_its_surroundings(body):
    story = f"<h1>The title &amp; more</h1><p>{PROSE}</p><p>First<br>second&nbsp;part <b>bold</b>er</p><ul><li>one</li><li>two</li></ul><p>{PROSE}</p>"
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{CHROME[0]}{CHROME[1]}{body.format(story)}{CHROME[2]}</body></html>"
    want = " ".join(f"The title & more {PROSE} First second part bolder one two {PROSE}".split())
    assert H.main_text(page, {}) == want


@pytest.mark.parametrize("noise", [
    '<form><p>Your name</p><input></form>', '<div id="comments"><article><p>I disagree with this.</p></article></div>',
    '<div class="cookie-notice"><p>We use cookies.</p></div>', '<div role="complementary">Side story</div>', "<!-- <p>hidden</p> -->",
    '<style>.x{}</style>', '<script>document.write("<p>text</p>")</script>', '<section class="related-links"><p>Read this</p></section>'])
def test_elements_inside_the_article_are_left_out(noise):
    page = f"<body>{CHROME[0]}<article><p>{PROSE}</p>{noise}<p>{PROSE}</p></article>{CHROME[2]}</body>"
    assert H.main_text(page, {}) == " ".join((PROSE + PROSE).split())


@pytest.mark.parametrize("part", [
    '<div style="overflow:hidden">{}</div>', '<p title="A hidden valley">{}</p>', '<a href="/films/hidden-figures">{}</a>',
    '<a href="/story?id=share-price-falls">{}</a>', '<a href=/hidden/x>{}</a>', '<p data-hidden="x" data-id="share">{}</p>',
    '<h2 id="related-work">{}</h2>', '<section id="social-impact">{}</section>', '<p id="search-engines">{}</p>', '<span id="share">{}</span>',
    '<div class="overflow-hidden">{}</div>', '<div class="social-impact">{}</div>', '<div id="search-engines">{}</div>'])
def test_loose_words_in_attributes_drop_nothing(part):
    part = part.format("Words of this very part are kept.")
    want = " ".join(f"{PROSE} Words of this very part are kept. {PROSE}".split())
    assert H.main_text(f"<body>{CHROME[0]}<article><p>{PROSE}</p>{part}<p>{PROSE}</p></article>{CHROME[2]}</body>", {}) == want


@pytest.mark.parametrize("part", ['<div style="overflow:hidden">{}</div>', '<h2 id="related-work">{}</h2>', '<div class="overflow-hidden">{}</div>',
                                  '<div class="hidden-xs has-sidebar">{}</div>'])
def test_loose_words_drop_nothing_without_marks(part):
    part = part.format("Words of this very part are kept.")
    assert H.main_text(f"<body><p>{PROSE}</p>{part}<p>{PROSE}</p></body>", {}) == " ".join(f"{PROSE} Words of this very part are kept. {PROSE}".split())


@pytest.mark.parametrize("part", [
    "<div hidden>{}</div>", "<div HIDDEN=''>{}</div>", "<div title='>' class=hidden>{}</div>", "<div class='visually-hidden'>{}</div>",
    "<div id=share>{}</div>", "<ul class='share-buttons'>{}</ul>", "<section id='comments'>{}</section>", "<p aria-hidden = 'true'>{}</p>"])
def test_named_elements_are_still_left_out(part):
    page = f"<body><article><p>{PROSE}</p>{part.format('Not of the story.')}<p>{PROSE}</p></article></body>"
    assert H.main_text(page, {}) == " ".join((PROSE + PROSE).split())


STORY = f"<h1>Head</h1><p>{PROSE}</p>"


@pytest.mark.parametrize("page", [
    '<article class="comment">{}</article>', '<div class="has-comments"><article>{}</article></div>',
    '<main><article class="comment">{}</article></main>', '<div class="comment-page"><main>{}</main></div>',
    '<form id="aspnetForm"><div id="page"><article>{}</article></div></form>', '<form id="aspnetForm"><div>{}</div></form>',
    '<main><form><article>{}</article></form></main>'])
def test_a_form_or_comment_word_around_the_content_is_lifted(page):
    page = f"<body>{page.format(CHROME[0] + STORY + CHROME[1])}{CHROME[2]}</body>"
    assert H.main_text(page, {}) == "Head " + " ".join(PROSE.split())


def test_a_form_around_a_page_without_marks_is_lifted():
    assert H.main_text(f"<body><form id='aspnetForm'><a href='#'>Skip</a>{CHROME[0]}<div>{PROSE}</div></form></body>", {}) == " ".join(PROSE.split())


@pytest.mark.parametrize("part", ['<section id="discussion">{}</section>', '<section class="discussion">{}</section>',
                                  '<div class="section" id="discussion">{}</div>', '<section id="comment">{}</section>'])
def test_a_discussion_section_is_kept(part):
    page = f"<body><article>{STORY}{part.format('<h2>Discussion</h2><p>We compare results.</p>')}<p>End.</p></article></body>"
    assert H.main_text(page, {}) == " ".join(f"Head {PROSE} Discussion We compare results. End.".split())


@pytest.mark.parametrize("part", [
    '<article class="comment"><p>I disagree.</p></article>', '<div id="comments"><article class="comment"><h1>No</h1><p>I disagree.</p></article></div>',
    '<div class="comment-list"><article><p>I disagree.</p></article></div>', '<form><h1>Join</h1><p>Your name</p></form>'])
@pytest.mark.parametrize("around", ["<article>{}</article>{}", "<main>{}{}</main>", "<article>{}{}</article>"])
def test_comments_and_forms_below_the_content_stay_out(part, around):
    page = f"<body>{around.format(STORY, part)}</body>"
    assert H.main_text(page, {}) == "Head " + " ".join(PROSE.split())


def test_a_wrapper_with_a_suspicious_class_is_kept():
    page = f'<body><div class="page has-sidebar"><article class="post has-sidebar"><header><h1>Head</h1></header><p>{PROSE}</p></article></div></body>'
    assert H.main_text(page, {}) == "Head " + " ".join(PROSE.split())


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<<<>>>", "<p", "<p class='x", "</div></p>", "<script>", "<!--", "&", "<a href=\"" + "x" * 10000])
def test_odd_pages_do_not_fail(page):
    assert isinstance(H.main_text(page, {}), str)


def test_broken_markup_and_bare_text():
    assert H.main_text("just some words here", {}) == "just some words here"
    assert H.main_text(f"<p>{PROSE}<p><b>Second {PROSE}<br><p>Third", {}) == " ".join(f"{PROSE} Second {PROSE} Third".split())
    assert H.main_text("<p>5 < 6 &lt; 7 &#233; &eacute;</p>", {}) == "5 < 6 < 7 é é"


# As learnt from pages whose articles hold headlines and paragraphs only.
POOR = {"<div>": -3.0, "<ul>": -3.0, "<li>": -3.0, "<table>": -3.0, "<td>": -3.0, "<body>": -3.0, "<p>": -0.0125, "<h1>": -0.0125, "<article>": -0.0125,
        "p": 3.0, "h1": 3.0, "div": -3.0, "li": -3.0, "li+a": -3.0, "td": -3.0, "p+a": -3.0}


@pytest.mark.parametrize("inner, want", [
    ('<h1>T</h1><div class="c"><div><div>one two three four five</div></div></div><p>six seven</p>', "T one two three four five six seven"),
    ("<p>a b c d</p><div><div><div><div>x</div></div></div></div><p>z</p>", "a b c d x z"),
    ('<p>a b</p><ul><li><a href="/1">first link</a></li><li><a href="/2">second</a></li></ul>', "a b first link second"),
    ("<div>" * 40 + "deep" + "</div>" * 40 + "<p>a b</p>", "deep a b"),
    ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table><p>below it</p><table><tr><td>4</td></tr></table>", "1 2 3 below it 4"),
    ("<div>only words of blocks</div>", "only words of blocks"),
    ('<p><a href="#">all is a link</a></p>', "all is a link"),
    ("<ul><li>one<ul><li>two</li></ul></li></ul>", "one two"),
    ('<p>a</p><div class="ad">Buy</div><nav>Home</nav><aside>See</aside><form>Name</form><p>z</p>', "a z")])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", '<div itemprop="articleBody">{}</div>',
                                    "<main><article>{}</article></main>", '<div id="wrap"><div><article class="post">{}</article></div></div>'])
@pytest.mark.parametrize("weights", [{}, POOR])
def test_marked_content_is_kept_whole(inner, want, around, weights):
    page = f"<body>{CHROME[0]}{CHROME[1]}<div>Site line</div>{around.format(inner)}<div><div>Words of the site</div></div>{CHROME[2]}</body>"
    got = H.main_text(page, weights)
    assert got == want if weights else want in got       # without weights nothing tells a site's unnamed blocks


def test_main_around_an_article_is_not_all_content():
    page = f"<body><main><div>Site line</div><article><p>{PROSE}</p><div>end</div></article><div><div>Other words</div></div></main></body>"
    assert H.main_text(page, POOR) == " ".join(f"{PROSE} end".split())


def test_a_tag_unseen_in_content_is_no_proof_against_it(spark):
    page = f"<body>{'<div><div></div></div>' * 9}<article><h1>T</h1><p>{PROSE}</p></article></body>"
    w = H.learn(spark.createDataFrame([(page,)] * 20, "html string"))
    assert w["<div>"] == H.UNSEEN
    want = " ".join(f"{PROSE} x {PROSE}".split())
    assert H.main_text(f"<body><p>{PROSE}</p><div><div><div>x</div></div></div><p>{PROSE}</p></body>", w) == want


def test_neither_the_word_lists_nor_the_weights_alone_are_enough(monkeypatch):
    """An unnamed block of the site needs the weights, an advert in a paragraph of the article the word lists."""
    page = f'<body><div>Site words here</div><h1>T</h1><p>{PROSE}</p><p class="ad">Buy it now</p><p>{PROSE}</p><div>More of the site</div></body>'
    want = " ".join(f"T {PROSE} {PROSE}".split())
    assert H.main_text(page, POOR) == want
    assert "Site words" in H.main_text(page, {}) and "More of the site" in H.main_text(page, {})
    monkeypatch.setattr(H, "NEVER_WORDS", set())
    assert H.main_text(page, POOR) == " ".join(f"T {PROSE} Buy it now {PROSE}".split())


def test_best_region_is_the_maximum():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(-4, 4, rng.integers(0, 12)).astype(float).tolist()
        best = max([sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)], default=0)
        a, b = H.best_region(s)
        assert sum(s[a:b]) == max(best, 0)


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", f"<body>{CHROME[0]}<article><p>{PROSE}</p></article></body>"), (1, "u", None), (None, None, ""), (2, "v", "<p>x " * 60000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(0) for c in ("text", "n_chars", "c0")})
    out = H.extract(df, H.learn(df)).collect()
    assert len(out) == 4 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert sorted(r["text"][:11] for r in out) == ["", "", "Plain words", "x x x x x x"]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.learn(none) == {} and H.extract(none, {}).count() == 0


def test_learnt_weights_have_the_right_signs(spark):
    page = f"<body>{CHROME[0]}<div>Some words above the story</div><article><h1>T</h1><p>{PROSE}</p></article><div>{'below ' * 9}</div></body>"
    w = H.learn(spark.createDataFrame([(page,)] * 20, "html string"))
    assert w["p"] > 0 > w["div"] and all(v < 0 for k, v in w.items() if k[0] == "<")
    assert H.main_text(page, w) == "T " + " ".join(PROSE.split())
