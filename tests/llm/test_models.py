"""The two classifiers on held-out rows, and main-text extraction on small pages."""

import os
import random
import time
import zlib
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest

from starmart.llm import html_extraction, language_id, toxicity
from starmart.llm.html_extraction import main_text
from starmart.llm.queries import QUERIES
from starmart.llm.toxicity import featurised

MODEL_DIR = os.environ.get("TEST_MODEL_DIR", "/root/testdata/sf0.1")


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_toxicity_on_held_out_rows(spark):
    labels = {
        r.doc_id: r.toxic for r in spark.read.parquet(f"{MODEL_DIR}/labels.parquet").collect()
    }
    rows = QUERIES["op1_toxicity"](spark, MODEL_DIR).collect()
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    for verdict in ("predicted", "toxic_for_language"):
        pairs = [(labels[r.doc_id], r[verdict]) for r in rows if r.held_out and r.doc_id in labels]
        hits = sum(1 for toxic, found in pairs if toxic and found)
        # A few hundred toxic rows to learn from; with some thousands nearly all are found.
        assert hits >= 0.8 * sum(toxic for toxic, _ in pairs)
        assert hits >= 0.85 * sum(found for _, found in pairs)


def test_language_on_held_out_rows(spark):
    langs = {
        r.doc_id: r.lang for r in spark.read.parquet(f"{MODEL_DIR}/documents.parquet").collect()
    }
    rows = [r for r in QUERIES["op8_language_id"](spark, MODEL_DIR).collect() if r.held_out]
    right = sum(langs[r.doc_id] == r.lang_pred for r in rows if r.lang_pred != "und")
    assert right >= 0.97 * len(rows)


def test_scores_do_not_depend_on_the_batch():
    texts = ["some words here", None, "", "x " * 5000, "one"] * 3
    rng = np.random.default_rng(0)
    model = toxicity.train(featurised(["bad words", "good words"] * 10), np.array([1.0, 0.0] * 10))
    together = toxicity.logits(model, texts)
    alone = [toxicity.logits(model, [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)
    order = rng.permutation(len(texts))
    assert np.allclose(toxicity.logits(model, [texts[i] for i in order]), together[order], atol=1e-5)


def test_blocks_of_positions_do_not_change_scores(monkeypatch):
    model = toxicity.train(featurised(["bad words", "good words"] * 10), np.array([1.0, 0.0] * 10))
    texts = ["a b c d e f g bad words", "", "h i j", "k " * 50]
    whole = toxicity.logits(model, texts)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.allclose(toxicity.logits(model, texts), whole, atol=1e-5)


def logit_by_force(model, text):
    """Each filter at each place, by the definition."""
    words = toxicity.WORD.findall((text or "").lower())
    vectors = [model.embeddings[toxicity.features(w)].sum(axis=0) for w in words]
    nothing = np.zeros(toxicity.WIDTH, dtype=np.float32)
    hidden = []
    for s, span in enumerate(toxicity.SPANS):
        padded = vectors + [nothing] * span
        places = [np.concatenate(padded[i : i + span]) for i in range(len(words))]
        places = places or [np.tile(nothing, span)]
        for f in range(toxicity.FILTERS):
            found = [float(place @ model.filters[s][:, f] + model.biases[s][f]) for place in places]
            hidden.append(max([*found, 0.0]))
    return float(np.dot(hidden, model.weights) + model.bias)


def test_scores_are_those_of_the_convolution():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{rng.integers(60)}" for _ in range(rng.integers(1, 40))) for _ in range(200)]
    model = toxicity.train(featurised(texts), (rng.random(200) < 0.4).astype(float))
    texts += ["", None, "w1", "W1 w2", "w1-w2 ... w3", "été"]
    assert np.allclose(toxicity.logits(model, texts), [logit_by_force(model, t) for t in texts], atol=1e-4)
    few = featurised([t for t in texts if t])
    again = toxicity.logits(model, [t for t in texts if t])
    assert np.allclose(toxicity.feature_logits(model, few), again, atol=1e-4)


def test_rows_of_one_id_are_one_training_row(spark):
    rows = [(i, f"text {i}", "en") for i in range(50)] + [(7, f"more {i % 3}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels).collect()
    assert sorted(r.doc_id for r in sample) == list(range(50))
    assert len({tuple(r) for r in sample} ^ {tuple(r) for r in toxicity.training_sample(
        docs.repartition(7), labels).collect()}) == 0
    assert language_id.training_sample(docs).count() == 50


def test_more_languages_than_classes(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    rows = [(100 * k + i, f"{chr(97 + k) * 3} {chr(97 + k) * 4} {i}", f"l{k}") for k in range(6) for i in range(5 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == ["l3", "l4", "l5"]
    found = {r.lang_pred for r in language_id.identify(docs, model).collect()}
    assert found <= {"l3", "l4", "l5"}


def language_by_force(model, text):
    """Cosines with all centroids, n-gram by n-gram."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    vector = language_id.ngram_counts(text).astype(np.float64) * model.idf
    length = np.sqrt((vector * vector).sum())
    cosines = [float((vector * c).sum() / length) for c in model.centroids]
    best = int(np.argmax(cosines))
    return model.languages[model.owners[best]], cosines[best]


def test_languages_are_those_of_the_nearest_centroid(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs)
    texts = [r.text for r in docs.select("text").limit(60).collect()] + [None, "", "12", "x"]
    langs, scores, _ = language_id.predict_texts(model, texts)
    expected = [language_by_force(model, t) for t in texts]
    assert langs == [lang for lang, _ in expected]
    assert np.allclose(scores, [max(0, min(1, s)) for _, s in expected], atol=1e-4)


def test_training_separates_and_thresholds_follow_languages():
    rng = np.random.default_rng(1)
    texts, toxic, langs = [], [], []
    for i in range(600):
        bad = i % 3 == 0
        words = [f"w{rng.integers(500)}" for _ in range(30)]
        if bad:
            words[rng.integers(30)] = ("vile", "vilest", "vileness")[i % 9 // 3]
        texts.append(" ".join(words))
        toxic.append(float(bad))
        langs.append("xx" if i % 2 else None)
    toxic = np.array(toxic)
    model = toxicity.train(featurised(texts[:400]), toxic[:400])
    toxicity.calibrate(model, featurised(texts[400:]), toxic[400:], langs[400:], np.ones(200))
    found = model.scores(toxicity.logits(model, texts[400:])) >= toxicity.THRESHOLD
    assert (found == (toxic[400:] == 1)).mean() > 0.97
    assert set(model.thresholds) <= {"xx", "None"}


def test_best_threshold():
    scores = np.array([0.9, 0.8, 0.7, 0.2, 0.1])
    assert toxicity.best_threshold(scores, np.array([1, 1, 0, 0, 0]), np.ones(5)) == pytest.approx(0.75)
    ties = np.array([0.5, 0.5, 0.1])
    assert toxicity.best_threshold(ties, np.array([1, 0, 0]), np.ones(3)) == pytest.approx(0.3)


def test_mislabelled_texts_get_no_centroid():
    one = [f"alpha beta gamma delta {i % 7}" for i in range(100)]
    two = [f"ομηρος ιθακη τροια {i % 7}" for i in range(100)] + one[:3]
    model = language_id.fit_rows(one + two, ["one"] * 100 + ["two"] * 103)
    langs, scores, rejected = language_id.predict_texts(model, [one[0], two[0], "¿?", None, "12"])
    assert langs == ["one", "two", "und", "und", "und"]
    assert scores[0] > 0.5 and scores[2] == 0 and rejected.tolist()[2:] == [True] * 3
    assert not rejected[0] and language_id.predict_texts(model, ["zzzzz qqqq"])[2][0]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<div id="cookie-notice">We use cookies, and more cookies, for your comfort and for ours.</div>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
{content}
<section class="comments"><p>First! A reader writes a rather long comment here, twice.</p></section>
<aside>Related</aside><form><p>Sign up</p></form><footer>&copy; 2020</footer></body></html>"""


@pytest.mark.parametrize(
    "content",
    [
        "<article><h1>Title</h1><p>One &amp; <b>two</b>,\n  three.<br>Four.</p><p>Five, six.</p></article>",
        "<div class='content'><h1>Title</h1><p>One &#38; two, three. Four.<p>Five, six.</div>",
        "<main><div><h1>Title</h1></div><div><p>One & <i>two</i>, three. Four.</p>"
        "<div class='ad'>Buy!</div><p>Five,&nbsp;six.</p></div></main>",
    ],
)
def test_main_text(content):
    assert main_text(PAGE.format(content=content)) == "Title\n\nOne & two, three. Four.\n\nFive, six."


def test_pages_without_markup_or_end():
    assert main_text(None) == main_text("") == main_text("<p></p>") == ""
    assert main_text("plain text, no tags") == "plain text, no tags"
    assert main_text("<article><p>Cut off in the middle of a ta<b cla") == (
        "Cut off in the middle of a ta"
    )
    assert main_text("<p>a<!-- not closed <p>b</p>") == "a"
    assert main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"


def test_unmarked_boilerplate_goes_by_its_ratios():
    story = "".join(
        f"<p>A long paragraph, the {n}th, with commas, full stops. And more, too.</p>"
        for n in range(6)
    )
    links = "".join(f"<td><a href='{n}'>Go {n}</a></td>" for n in range(12))
    text = main_text(f"<body><table><tr>{links}</tr></table><div>{story}</div></body>")
    assert text.count("\n\n") == 5 and "Go" not in text


STORY = "".join(
    f"<p>A long paragraph, the {n}th, with commas, full stops. And more, too.</p>" for n in range(4)
)


@pytest.mark.parametrize(
    "around",
    [
        'div class="has-sidebar"',
        'div id="page" class="no-comments"',
        'div class="row with-header"',
        'div class="search-result"',
        'div class="sidebar"',
        'form id="aspnet"',
        'div class="flex hidden md:block"',
        'div title="the hidden costs"',
        'div data-class="menu" data-id="sidebar"',
    ],
)
def test_names_around_the_article_do_not_hide_it(around):
    end = f"</{around.split()[0]}>"
    for story in (STORY, f"<article>{STORY}</article>", f"<main>{STORY}</main>"):
        page = f"<body><nav>Home</nav><{around}>{story}{end}<footer>End</footer></body>"
        assert main_text(page) == main_text(f"<body>{STORY}</body>") != ""


def test_names_inside_the_article_go_by_the_ratios():
    parts = (
        f"<section id='discussion'>{STORY}</section>"
        "<h2 id='related-work'>Work</h2><h2 id='discussion'>Talk</h2>"
        "<p id='notice'>Readers note, please, that this matters. It does, as shown above.</p>"
    )
    text = main_text(f"<body><article>{STORY}{parts}<div class='ad'>Buy!</div></article></body>")
    assert text.count("A long paragraph") == 8 and "Work" in text and "Talk" in text
    assert "Readers note" in text and "Buy" not in text


def test_what_is_hidden_or_marked_still_goes():
    more = "<p>Other text, rather long, with commas. It is no part of this article, is it?</p>"
    for tag in ('div hidden', 'div style="display: none"', 'div class="comments"', "aside"):
        page = f"<body><article>{STORY}</article><{tag}>{more}</{tag.split()[0]}></body>"
        assert "Other text" not in main_text(page)
        page = f"<body><article>{STORY}<{tag}>{more}</{tag.split()[0]}></article></body>"
        assert "Other text" not in main_text(page)


NOT_THE_ARTICLE = (
    "comments-section comment-list user-comments reader-comments post-comments ad-slot "
    "ad-container advert-box sponsored-content cookie-bar related-posts related-articles "
    "share-buttons social-links newsletter-box subscribe-form sidebar-left site-footer page-header "
    "main-nav promo-box widget-area notice-box"
).split()
LONG = "<p>Other text, rather long, with commas. It is no part of this article, is it?</p>" * 2
LINKS = "<a href='1'>One</a> <a href='2'>Two</a>"


@pytest.mark.parametrize("name", NOT_THE_ARTICLE)
def test_compound_names_leave_their_elements_out(name):
    expected = main_text(f"<body>{STORY}</body>")
    for inner in (LONG, LINKS):
        part = f'<div class="{name}">{inner}</div>'
        for tag in ("article", "main", "div"):
            inside = f"<body><{tag}>{STORY}{part}{STORY}</{tag}></body>"
            assert main_text(inside) == f"{expected}\n\n{expected}"
            outside = f"<body><{tag}>{STORY}</{tag}>{part}</body>"
            assert main_text(outside) == expected


def test_nothing_is_added_to_an_article_that_the_page_names():
    page = f"<body><article>{STORY * 3}</article><div><p>Unmarked, but long enough to be chosen.</p></div></body>"
    assert "Unmarked" not in main_text(page)


def test_names_of_parts_of_an_article():
    parts = (
        '<div class="article-header"><h1>Title</h1></div><section id="related-work"><p>See, too.</p>'
        '</section><div class="side-by-side"><p>Left, as shown in figure one, and right.</p></div>'
    )
    text = main_text(f"<body><article>{parts}{STORY}</article></body>")
    assert text.startswith("Title") and "Left, as shown" in text


def test_quotes_in_unquoted_values_are_letters():
    assert main_text("<p title=don't>One</p><p class=it's>Two</p>") == "One\n\nTwo"
    assert main_text('<p title="a > b">One</p>') == "One"
    assert main_text('<p data-x=a"b>One</p><p title = \'x>y\'>Two</p>') == "One\n\nTwo"
    assert main_text("<p a=\"never closed>One</p>") == "One"


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 40_000 + "</i>" * 40_000,
        "<div><b>" + "<p><i>" * 20_000 + "</b>" * 20_000,
        "<li>" * 40_000,
        "<a <a " * 40_000,
        "<p x='" * 40_000,
        "<p x=\"'>" * 20_000,
        "<svg>" * 40_000,
        "<!-- " * 40_000 + ">",
        "<ul><li>" * 10_000 + "</ul>" * 20_000,
    ],
)
def test_broken_markup_costs_no_more_than_its_length(page):
    start = time.perf_counter()
    main_text(f"<article>{STORY}</article>{page}")
    assert time.perf_counter() - start < 4


class Tree(HTMLParser):
    """A page as the library's parser sees it: text nodes with their paths of names."""

    def __init__(self, html):
        super().__init__()
        self.path, self.nodes = (), []
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        self.path += ((tag, dict(attrs).get("class") or ""),)

    def handle_endtag(self, tag):
        self.path = self.path[:-1]

    def handle_data(self, data):
        self.nodes.append((self.path, data))


def scores_by_force(html):
    """Tag-path ratios by their definition, for a well-formed page."""
    nodes = [(path, text) for path, text in Tree(html).nodes if text.strip()]
    fused = [0.0] * len(nodes)
    for value in (lambda t: len(t.strip()), lambda t: len(html_extraction.PUNCTUATION.findall(t))):
        own = defaultdict(list)
        for path, text in nodes:
            own[path].append(value(text))
        ratios = [sum(own[path]) / len(own[path]) for path, _ in nodes]
        ratios = [r / max([*ratios, 1]) for r in ratios]
        for i in range(len(nodes)):
            for k, weight in zip(range(-2, 3), html_extraction.KERNEL, strict=True):
                fused[i] += weight * ratios[min(max(i + k, 0), len(nodes) - 1)] / 2
    by_path = defaultdict(list)
    for (path, _), f in zip(nodes, fused, strict=True):
        by_path[path].append(f)
    scores = [sum(by_path[path]) / len(by_path[path]) for path, _ in nodes]
    return [s / max(scores) for s in scores]


def test_path_scores_by_force():
    rng = random.Random(8)
    for _ in range(40):
        html = "<body>"
        for _ in range(rng.randrange(1, 15)):
            tag, name = rng.choice(["div", "section", "td"]), rng.choice(["", "x", "story", "y z"])
            words = " ".join(rng.choices(["a", "long", "words,", "here.", "to", "read;"], k=rng.randrange(1, 30)))
            html += f'<{tag} class="{name}"><span>{words}</span> tail {rng.choice([",", ""])}</{tag}>'
        page = html_extraction.Page(html + "</body>")
        found = html_extraction.node_scores(page, [False] * len(page.parents))
        worded = [i for i, t in enumerate(page.texts) if t.strip()]
        assert np.allclose(found[worded], scores_by_force(html + "</body>"), atol=1e-9)
