"""Tokens, BPE, language and main text on unusual rows."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallymill.llm import bpe, html, language, tokens

DOCS = "doc_id long, text string, lang string, score string"
CHARS = "abcdefgi the'sldvmABC  \n\t019½ÉéßΣİǅＡ😀中文<|endoftext|>́\u0085 \x1c²ª.,!"
BYTE, RANKS, WORD = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(WORD), Tokenizer.from_file(WORD)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(CHARS) | st.characters(codec="utf-8"), max_size=60))
def test_bpe_equals_library(codec, text):
    own, library = codec
    found = own.encode(text)
    assert np.frombuffer(found, "<u4").tolist() == (expected := ids(library, text))
    assert own.decode(found).decode() == library.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 5000, "ab" * 2000, "aba" * 999, "the" * 700, "!?" * 500, "<|startoftext|>" * 50])
def test_bpe_of_long_repetitive_words(codec, word):
    own, library = codec
    assert np.frombuffer(own.encode(word), "<u4").tolist() == ids(library, word)


def test_counts_equal_library_in_small_chunks():
    library = Tokenizer.from_file(BYTE)
    own, small = tokens.Counter(BYTE, RANKS), tokens.Counter(BYTE, None, chunk=64, overlap=8)
    draw = random.Random(5)
    texts = ["".join(draw.choices(CHARS, k=draw.randint(0, 2000))) for _ in range(300)]
    texts += ["a" * 5000 + " b" * 50, " " * 3000 + "x", "<|endoftext|>" * 300, "!" * 400 + "<|endoftext|>" * 5, "\n \n" * 900]
    for text in texts:
        assert own.count(text) == small.count(text) == len(ids(library, text))


def test_row_operators_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (2, "", "en", "y"), (3, "a " * 60_000, "en", "z"), (None, "b c", None, None)], DOCS)
    counted = {(r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs, BYTE, RANKS).collect()}
    assert counted == {(1, 0, 0), (2, 0, 0), (3, 120_000, 60_001), (None, 3, 2)}
    assert tokens.count_tokens(docs, BYTE).count() == 5
    coded = bpe.encode_documents(docs, WORD).where("doc_id = 3").first()
    assert (len(coded.ids), coded.decoded[:11]) == (60_000, "a</w> a</w>")
    assert bpe.encode_digests(docs, WORD).count() == 5
    for df in (tokens.count_tokens(docs.limit(0), BYTE), bpe.encode_digests(docs.limit(0), WORD)):
        assert df.collect() == []


def test_language_of_odd_rows(spark):
    teach = [(i, "the house and the garden with trees", "en", "") for i in range(9)]
    teach += [(10 + i, "das haus und der garten mit bäumen", "de", "") for i in range(9)] + [(99, None, "fr", ""), (98, "le", None, "")]
    profile = language.learn(spark.createDataFrame(teach, DOCS))
    assert profile.langs == ("de", "en")
    rows = [(1, None), (2, ""), (3, "12 !"), (4, "the"), (5, "gartenhaus"), (6, "gardens"), (7, "漢字"), (8, "und " * 50_000), (4, "the")]
    docs = spark.createDataFrame([(i, t, None, "kept") for i, t in rows], DOCS)
    found = sorted((r.doc_id, r.lang_pred) for r in language.identify(docs, profile).collect())
    assert found == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de"), (6, "en"), (7, "de"), (8, "de")]
    kept = language.keep_identified(docs, profile, 0.6)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [4, 4, 5, 6, 8]
    nothing = language.learn(spark.createDataFrame([], DOCS))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_every_document_teaches_its_language(spark):
    n = 9_000  # more than were sampled; each word occurs twice, in two documents
    words = [("abcdefghij"[i // 1000 % 10] + "abcdefghij"[i // 100 % 10] + "abcdefghij"[i // 10 % 10] + "abcdefghij"[i % 10]) * 2 for i in range(n // 2)]
    teach = [(i, words[i // 2], "en", "") for i in range(n)] + [(n + i, "z", "de", "") for i in range(3)]
    profile = language.learn(spark.createDataFrame(teach, DOCS))
    assert (profile.words.find([language._key(w) for w in words]) >= 0).all()
    assert len(profile.words.keys) == n // 2 + 1


PAGE = """<!doctype html><html><head><title>No title</title><style>p{}</style></head><body class="page">
<nav><a href=/a>Menu one</a> <a>Menu two</a></nav><div id="cookie-notice">We use cookies and more cookies here</div>
<header>Site name</header><article><h1>Head&amp;line</h1><p>First <b>bo</b>ld &lt;text&gt;&nbsp;here<br>goes on
<p>Second   one<script>var a = "</p>";</script> ends.<div class="adBox ads">Buy this now please</div>
<ul><li>Item a<li>Item b</ul><section class="comments"><p>I disagree with all of this</p></section></article>
<aside>Related pages to read</aside><form>Search <input></form><footer>&copy; us</footer>"""
TEXT = "Head&line\nFirst bold <text> here goes on\nSecond one ends.\nItem a\nItem b"


def test_main_text_leaves_out_what_is_not_article():
    assert html.main_text(PAGE, html.Weights()) == TEXT


WORDS = "Many words of the story itself stand here one after another in a row "
STORY = f"<article><h1>The head of it</h1><p>{WORDS * 3}</p></article>"
FOUND = "The head of it\n" + " ".join((WORDS * 3).split())
MENU = "<nav><a href=/>Home</a> <a href=/b>About us</a></nav>"
TEASER = "<article><p>Another story that may be of interest to you</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f'<body><form id="aspnetForm" action="x"><div class="menu">Home and more</div>{STORY}<footer>End</footer></form>',
        f'<body>{MENU}<div class="has-sidebar">{STORY}<div class="sidebar">Other things to read</div></div>',
        f'<body>{MENU}<div id="page" class="with-sidebar"><main>{STORY}</main><aside>Other things</aside></div>',
        f'<body>{MENU}<div class="layout sidebar right">{STORY}<div class="sidebar">Other things to read</div></div>',
        f'<body><div class="post comments-open">{STORY}<div id="comments"><article>I disagree with this</article></div></div>',
        f'<body><nav><a href=/>Home</a><main>{STORY}</main>',
        f'<body><main><div class="widget">{STORY}</div></main>',
        f'<body><form>{STORY}<div class="related">{TEASER * 3}</div></form>',
        f'<body>{STORY}<div class="related">{TEASER * 3}</div><aside>{STORY}</aside>',
        f"<body><form><h1>The head of it</h1><div><p>{WORDS * 3}</p></div></form>{MENU}",
        f'<body>{MENU}<div class="layout sidebar right"><h1>The head of it</h1><p>{WORDS * 3}</p></div>',
        f'<body>{MENU}<article><div class="entry-header"><h1>The head of it</h1></div><p>{WORDS * 3}</p></article>',
        f"<body>{MENU}<main><h1>The head of it</h1><article><p>{WORDS * 3}</p></article></main>",
    ],
)
def test_what_stands_around_the_article_does_not_set_it_aside(page):
    assert html.main_text(page, html.Weights()) == FOUND


@pytest.mark.parametrize("aside", [f'<div class="related">{TEASER}</div>', f'<div id="comments">{TEASER * 9}</div>', f"<aside>{TEASER}</aside>"])
def test_articles_in_asides_are_not_taken_for_the_article(aside):
    page = f"<body><div><h1>The head of it</h1><p>{WORDS * 3}</p></div>{aside}"
    assert html.main_text(page, html.Weights()) == FOUND


@pytest.mark.parametrize(
    "part",
    [
        f"<table class='share-prices'><tr><td>{WORDS}</table>",
        f"<p class='notice'>{WORDS}</p>",
        f"<div class='ad-hoc-committee'>{WORDS}</div>",
        f"<h2 id='comments-on-the-law'>{WORDS}</h2>",
        f"<ul class='social-history'><li>{WORDS}</ul>",
    ],
)
def test_a_class_that_tells_of_the_story_keeps_its_text(part):
    page = f"<body>{MENU}<article><h1>The head of it</h1>{part}<p>{WORDS * 3}</p><div class='comments-list'><p>I disagree with it</p></div><div class='adSlot'>Buy now</div></article>"
    assert html.main_text(page, html.Weights()).split("\n") == ["The head of it", WORDS.strip(), " ".join((WORDS * 3).split())]


def test_stray_ends_among_many_open_elements_take_linear_time():
    import time

    page = "<article><p>" + "<b>" * 20_000 + f"{WORDS * 3}" + "</i>" * 20_000 + "</article>"
    begun = time.process_time()
    html.main_text(page, html.Weights())
    assert time.process_time() - begun < 4


def test_the_border_keeps_its_measure_in_words(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    weights = html.learn(pages)
    assert weights.border == pytest.approx(-20 * weights.word)
    assert html.Weights().border == -20 * html.Weights().word


def test_best_region_is_the_first_of_equals():
    assert html.best_region([-1.0, 2.0, -1.0, 3.0, -9.0, 4.0]) == (1, 4)
    assert html.best_region([-1.0, 0.0]) == (0, 0)


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "<div class='", "plain words", "<p>" * 2000 + "x", "</p>" * 50, "<script>x", "&am", "<a" * 500])
def test_main_text_of_broken_pages(page):
    assert len(html.main_text(page, html.Weights())) <= len(page)


def test_pages_table(spark):
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (3, "v", "", "")], schema)
    weights = html.learn(pages)
    assert weights.word > 0 > max(weights.tags.values())
    found = sorted((r.page_id, r.text, r.n_chars) for r in html.extract(pages, weights).collect())
    assert found == [(1, TEXT, len(TEXT))] * 2 + [(2, "", 0), (3, "", 0)]
    assert html.learn(pages.limit(0)) == html.Weights()
    assert html.extract(pages.limit(0), weights).collect() == []
