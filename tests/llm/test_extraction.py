"""Main texts of pages: whole tables against their markup, held-out layouts, odd pages."""

import html
import re

import numpy as np
import pytest

from paylake.llm import extraction, page_blocks
from paylake.llm.queries import registered


def blocks_of(page):
    vectors = page_blocks.Vectors(np.ones((page_blocks.PATH_BUCKETS, 1)))
    return [block.text for block in page_blocks.blocks(page, vectors)]


def article(page):
    """The article as the markup of the test tables has it, by patterns alone."""
    inner = re.search("(?s)<article>(.*?)(</article>|$)", page)
    parts = re.split(r"(?i)</?(?:p|h1)\b[^>]*>", inner.group(1)) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", part)).split()) for part in parts]
    return "\n\n".join(text for text in texts if text)


def test_tables(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = registered()["op13_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == article(pages[row.page_id].html or ""), row.url
        assert row.url == pages[row.page_id].url and row.n_chars == len(row.text)


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    return [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").limit(120).collect()]


@pytest.fixture(scope="module")
def model(sample):
    return extraction.train(extraction.training_pages(sample[: len(sample) // 2]))


def labelled(model, pages):
    found = extraction.labelled(pages, model, page_blocks.Vectors(model.w["path"]), page_blocks.WordBuckets())
    return {number: (blocks, scores > 0) for number, blocks, scores in found}


def test_held_out_layouts(sample, model):
    """Layouts and texts the model has not seen; some have no names at all."""
    told = [t for page in sample[len(sample) // 2 :] for t in extraction._told_apart(page)]
    layouts = extraction.Layouts([t for t, label in told if label == 1], [t for t, label in told if label == 0], 77)
    pages = [layouts.page() for _ in range(400)]
    truth = [[extraction.MAIN in text for text in blocks_of(page)] for page in pages]
    shown = [page.replace(extraction.MAIN, "").replace(extraction.OTHER, "") for page in pages]
    right = count = 0
    for number, (_, labels) in labelled(model, shown).items():
        if len(labels) == len(truth[number]):
            right += (labels == np.array(truth[number])).sum()
            count += len(labels)
    assert count > 5000 and right / count >= 0.97, right / count


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page">
<header class="site-header"><p>The Daily</p><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies on this site.</p><button>Accept all</button></div>
<div id="container"><aside class="sidebar"><h3>Related articles</h3><ul><li><a href=/1>Another story</a></ul></aside>
<div class="post-content"><h1>A headline &amp; more</h1><p>First  paragraph of the story,<br>with two lines.
<p>Second paragraph &mdash; it is <b>bo</b>ld.<div class="advert">Buy now and save!</div><p>Third and last paragraph.</p></div>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>What a nice story, I liked it.</p></div>
<div class="comment"><p>I do not agree with any of this.</p></div><form><label>Your comment</label><textarea>x</textarea><button>Send</button></form></section>
</div><footer>&copy; 2024 The Daily</footer><script>var t = "</p>";</script></body></html>"""


def test_a_page_of_another_kind(model):
    blocks, main = labelled(model, [PAGE])[0]
    assert [b.text for b, m in zip(blocks, main) if m] == [
        "A headline & more", "First paragraph of the story, with two lines.", "Second paragraph — it is bold.",
        "Third and last paragraph.",
    ]


def test_blocks():
    assert blocks_of("") == [] and blocks_of(" \n\t") == []
    assert blocks_of("plain &lt;b&gt; text") == ["plain <b> text"]
    assert blocks_of("<p>a<p>b<li>c<li>d<td>e<td>f") == ["a", "b", "c", "d", "e", "f"]
    assert blocks_of("<p>a <!-- <p>no --> b<script>if (a < b) '</p>'</script><style>x") == ["a b"]
    assert blocks_of("<p title='x > y'>a</p></div></p>b<hr>c") == ["a", "b", "c"]
    assert blocks_of('<p class="open>a</p><p>b') == ["a", "b"]
    assert blocks_of("a < b <3 <p") == ["a < b <3"]
    assert blocks_of("<p>x&nbsp;&#8203;y&am</p>") == ["x ​y&am"]
    assert blocks_of("<table><tr><td>a<td>b<tr><td><p>c</table>d") == ["a", "b", "c", "d"]
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000 + "<p>y"
    assert blocks_of(deep) == ["x", "y"]


def test_odd_pages(spark, model):
    rows = [
        (1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "<p"), (3, "u", "no markup at all"), (4, "u", PAGE), (4, "u", PAGE),
        (5, "u", "<article>" + "<p>One sentence of many, again and again.</p>" * 70_000 + "</article>"),
        (6, "u", "<html><body><nav><a href=/>Home</a></nav><footer>© x</footer>"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_main int")
    found = extraction.main_text(frame, model)
    assert found.columns == ["page_id", "url", "text", "n_main", "n_blocks"]
    texts = {}
    for row in found.collect():
        texts.setdefault(row.page_id, []).append(row.text)
    assert texts[1] == ["", ""] and texts[None] == [""] and len(texts[4]) == 2 and texts[6] == [""]
    assert texts[5] == ["\n\n".join(["One sentence of many, again and again."] * 70_000)]
    empty = extraction.main_text(frame.where("false"), extraction.fit(frame.where("false")))
    assert empty.count() == 0


def test_gradients():
    """The gradients through both sequences against differences."""
    rng = np.random.default_rng(0)
    w = {name: value.astype(np.float64) for name, value in extraction._fresh(rng).items()}
    lengths = np.array([5, 3])
    shape = (5, 2)
    path, word = rng.random((*shape, page_blocks.PATH_BUCKETS)), rng.random((*shape, page_blocks.WORD_BUCKETS))
    stat, labels = rng.random((*shape, page_blocks.STATISTICS)), rng.integers(0, 2, shape).astype(float)

    def loss():
        model = extraction.Model(w)
        scores = model.scores(path @ w["path"] + word @ w["word"] + stat @ w["stat"] + w["b"], lengths)
        p = extraction._sigmoid(scores)
        seen = np.arange(5)[:, None] < lengths
        return -(np.log(np.where(labels > 0, p, 1 - p)) * seen).sum() / seen.sum()

    grads = extraction._gradients(w, path, word, stat, labels, lengths)
    for name, value in w.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        kept = value[at]
        value[at] = kept + 1e-5
        above = loss()
        value[at] = kept - 1e-5
        below = loss()
        value[at] = kept
        assert abs((above - below) / 2e-5 - grads[name][at]) < 1e-6, name
