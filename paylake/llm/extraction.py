"""Main text of pages: a bidirectional LSTM labels every leaf block with the whole page in view.

A block is read as the sum of its tag-path vector, its hashed-word vector and a few
statistics.  One LSTM reads the blocks from the first to the last, another from the last to
the first, and a logistic unit over both and the block itself says whether it belongs to the
article.  All parts are trained together, in numpy, by gradients through the whole sequence.

No table labels blocks, so the model learns from layouts.  The texts are those of a bounded
sample of pages (``SAMPLE``), told apart by what their markup plainly says; they are put into
random layouts, with menus, headers, sidebars, notices, adverts, forms, comments and footers
in many spellings, some without any name, so that a block's neighbours matter.  Pages of the
sample whose markup is plain are learnt from as they are, too.

Pages are extracted where Spark reads them, in batches of about equal length; nothing is cut.

Defined cases: a NULL or empty page, and one without a block of the article, gives an empty
text.  Broken markup is repaired, see :mod:`paylake.llm.page_blocks`.  Repeated rows are pages
of their own; NULL ids and urls stay.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import page_blocks as B

# Pages whose texts are used for training, and the longest of them.
SAMPLE, LONGEST = 240, 60_000
LAYOUTS = 900
EPOCHS, BATCH, RATE = 12, 24, 0.01
K, H = 32, 24
THRESHOLD = 0.5

# Blocks times pages of one batch of sequences.
CELLS = 1 << 15
BLOCKS_AT_ONCE = 2048

# Private characters that mark the texts of a layout while it is parsed.
MAIN, OTHER = "\ue000", "\ue001"

# What markup is named by.
PLAIN_MAIN = {"article", "main"}
PLAIN_OTHER = {"nav", "footer", "header", "aside", "form", "button", "menu"}
NAMES = {
    "main": "content post entry story body main text article-body post-content entry-content article page-content "
    "story-body articleBody main-content",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu links tabs pagination",
    "header": "header masthead site-header topbar top branding logo banner",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner ad-slot adsbox advertising promoted",
    "notice": "notice cookie cookies cookie-banner consent gdpr alert newsletter subscribe popup modal warning message paywall privacy",
    "side": "sidebar side widget related recommended trending popular rail right-rail aside more read-next share social tags author-box",
    "comments": "comments comment-list discussion replies responses comment-section thread feedback user-comments disqus",
    "comment": "comment reply response user-comment comment-body commentary post-comment",
    "footer": "footer site-footer copyright bottom legal colophon foot imprint",
    "wrap": "container wrapper page row col inner layout outer grid box wrap site",
}
PHRASES = {
    "nav": "Home|About|Contact|News|Sport|Login|Archive|Products|Help|Start|Accueil|Inicio|Startseite|Next page|Older posts",
    "header": "Welcome|The Daily|My site|Subscribe now|Your source of news|Sign in",
    "ad": "Advertisement|Buy now and save!|Sponsored|Special offer: 50% off|Click here|Anzeige|Publicité|Publicidad",
    "notice": "We use cookies to improve your experience.|Accept all|Please subscribe to our newsletter.|This site uses cookies."
    "|Sign up for free|You have read all your free articles.|Wir verwenden Cookies.|JavaScript is disabled.",
    "side": "Related articles|Most read|Popular posts|Share this|Follow us|Tags|About the author|You may also like|Trending",
    "form": "Search|Name|E-mail|Your comment|Submit|Password|Send|Subscribe|Remember me",
    "comments": "Comments|3 comments|Leave a reply|Reply|says:|Kommentare|Commentaires|Load more comments",
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|Impressum|Powered by|Contact us|Copyright 2023",
}


# ---- layouts ----------------------------------------------------------------


class Layouts:
    """Pages with known labels, put together from texts at random."""

    def __init__(self, main: list[str], other: list[str], seed: int):
        self.rng = random.Random(seed)
        self.main, self.other = main, other or main

    def element(self, tags: str, kind: str, inner: str) -> str:
        """``inner`` in one of the tags, mostly named by one of the words of its kind."""
        rng = self.rng
        tag = rng.choice(tags.split())
        names = NAMES[kind].split()
        attribute = ""
        if rng.random() < (0.85 if tag in ("div", "section", "ul", "ol", "td", "li") else 0.4):
            name = rng.choice(names)
            name = rng.choice([name, name, f"{name} {rng.choice(NAMES['wrap'].split())}", f"{name}-{rng.randrange(9)}"])
            attribute = f' {rng.choice(["class", "class", "class", "id"])}="{name}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def phrase(self, kind: str, sentence: float = 0.5) -> str:
        rng = self.rng
        if rng.random() < sentence:
            return OTHER + rng.choice(self.other if rng.random() < 0.6 else self.main)[:400].replace("<", "&lt;")
        return OTHER + rng.choice(PHRASES[kind].split("|"))

    def links(self, kind: str) -> str:
        rng, n = self.rng, self.rng.randrange(1, 9)
        if rng.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.phrase(kind, 0.5)[:40]}</a></li>' for i in range(n)) + "</ul>"
        return " ".join(f'<a href="/{i}">{self.phrase(kind, 0.4)[:30]}</a>' for i in range(n))

    def paragraph(self, text: str) -> str:
        rng = self.rng
        if rng.random() < 0.15:
            return f"<p><b>{text}<br>"
        return f"<p>{text}" + ("</p>" if rng.random() < 0.8 else "")

    def ad(self) -> str:
        text = self.phrase("ad", 0.6)
        return self.element("div div aside section", "ad", rng_wrap(self.rng, text))

    def notice(self) -> str:
        return self.element("div div section aside", "notice", rng_wrap(self.rng, self.phrase("notice", 0.5)))

    def side(self) -> str:
        rng = self.rng
        parts = [f"<h3>{self.phrase('side', 0.3)[:80]}</h3>"] if rng.random() < 0.6 else []
        for _ in range(rng.randrange(1, 4)):
            parts.append(self.links("side") if rng.random() < 0.5 else self.paragraph(self.phrase("side", 0.7)))
        return self.element("aside aside div div section", "side", "".join(parts))

    def form(self) -> str:
        parts = []
        for _ in range(self.rng.randrange(1, 4)):
            text = self.phrase("form", 0.25)[:60]
            parts.append(self.rng.choice(["<label>{}</label><input>", "<p>{}</p>", "<button>{}</button>", "<select><option>{}</select>", "{}"]).format(text))
        return f"<form action='/s'>{''.join(parts)}</form>"

    def comments(self) -> str:
        rng = self.rng
        parts = [f"<h3>{self.phrase('comments', 0.1)}</h3>"] if rng.random() < 0.6 else []
        for _ in range(rng.randrange(1, 7)):
            text = OTHER + rng.choice(self.main).replace("<", "&lt;")
            inner = (f"<span>{OTHER}{rng.choice(['Ann', 'user1', 'Max'])}</span> " if rng.random() < 0.3 else "") + self.paragraph(text)
            if rng.random() < 0.2:
                inner += self.paragraph(OTHER + rng.choice(self.main)[:200].replace("<", "&lt;"))
            parts.append(self.element("div div li article section", "comment", inner))
        if rng.random() < 0.3:
            parts.append(self.form())
        return self.element("section div div ol ul", "comments", "".join(parts))

    def article(self) -> str:
        rng = self.rng
        text = lambda: MAIN + rng.choice(self.main).replace("<", "&lt;")
        parts = [f"<h1>{text()[:90]}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 14, 30])):
            r = rng.random()
            if r < 0.78:
                parts.append(self.paragraph(text()))
            elif r < 0.83:
                parts.append(f"<h2>{text()[:60]}</h2>")
            elif r < 0.87:
                parts.append(f"<blockquote>{self.paragraph(text())}</blockquote>")
            elif r < 0.91:
                items = "".join(f"<li>{text()[:120]}</li>" for _ in range(rng.randrange(1, 5)))
                parts.append(rng.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format(items))
            elif r < 0.93:
                parts.append(f"<pre>{text()}</pre>")
            elif r < 0.94:
                cells = "".join(f"<tr><td>{text()[:40]}</td><td>{text()[:40]}</td></tr>" for _ in range(2))
                parts.append(f"<table>{cells}</table>")
            elif r < 0.97:
                parts.append(self.ad())
            elif r < 0.985:
                parts.append(self.side())
            else:
                parts.append(self.notice())
        if rng.random() < 0.12:
            parts.append(self.comments())
        return self.element("article article article main div div section", "main", "".join(parts))

    def wrapped(self, inner: str) -> str:
        for _ in range(self.rng.choice([0, 0, 1, 2])):
            inner = self.element("div div section main", "wrap", inner)
        return inner

    def page(self) -> str:
        rng = self.rng
        navigation = lambda: self.element("nav nav div ul", "nav", self.links("nav"))
        before = [
            (0.4, lambda: self.element("header header div", "header", f"<p>{self.phrase('header', 0.4)[:80]}</p>" + (navigation() if rng.random() < 0.4 else ""))),
            (0.7, navigation), (0.25, self.notice), (0.5, self.ad), (0.2, self.form), (0.15, self.side),
        ]
        after = [
            (0.3, self.side), (0.3, self.comments), (0.2, self.ad), (0.15, self.form), (0.15, self.notice), (0.1, navigation),
        ]
        chosen = [[make() for chance, make in parts if rng.random() < chance] for parts in (before, after)]
        for parts in chosen:
            rng.shuffle(parts)
        inner = "".join(chosen[0]) + self.wrapped(self.article()) + "".join(chosen[1])
        footer = self.element("footer footer div", "footer", rng_wrap(rng, self.phrase("footer", 0.5))) if rng.random() < 0.8 else ""
        ending = "</body></html>" if rng.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{self.wrapped(inner)}{footer}{ending}"


def rng_wrap(rng: random.Random, text: str) -> str:
    return rng.choice([text, f"<p>{text}</p>", f"<span>{text}</span>"])


# ---- model ------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _reversed(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence (first axis: time) from its last block to its first; padding stays behind."""
    time = np.arange(len(x))[:, None]
    index = np.where(time < lengths, lengths - 1 - time, time)
    return np.take_along_axis(x, index.reshape(index.shape + (1,) * (x.ndim - 2)), axis=0)


def _lstm(x: np.ndarray, w: dict[str, np.ndarray], d: str, keep: bool):
    """Hidden states over time; with ``keep`` also what the gradient needs."""
    steps, size = x.shape[:2]
    h, c = np.zeros((size, H), x.dtype), np.zeros((size, H), x.dtype)
    projected = x @ w[d + "x"] + w[d + "b"]
    out, kept = np.empty((steps, size, H), x.dtype), []
    for t in range(steps):
        z = projected[t] + h @ w[d + "h"]
        gates = _sigmoid(z[:, : 3 * H])
        g = np.tanh(z[:, 3 * H :])
        i, f, o = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :]
        before, c_before = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            kept.append((i, f, o, g, c_before, tc, before))
    return out, kept


def _lstm_gradient(x, kept, given, w, d, grads) -> np.ndarray:
    steps, size = x.shape[:2]
    dh, dc = np.zeros((size, H), x.dtype), np.zeros((size, H), x.dtype)
    dz = np.empty((steps, size, 4 * H), x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c_before, tc, before = kept[t]
        dh = dh + given[t]
        dc = dc + dh * o * (1 - tc * tc)
        row = dz[t]
        row[:, :H] = dc * g * i * (1 - i)
        row[:, H : 2 * H] = dc * c_before * f * (1 - f)
        row[:, 2 * H : 3 * H] = dh * tc * o * (1 - o)
        row[:, 3 * H :] = dc * i * (1 - g * g)
        grads[d + "h"] += before.T @ row
        dh = row @ w[d + "h"].T
        dc = dc * f
    flat = dz.reshape(-1, 4 * H)
    grads[d + "x"] += x.reshape(-1, K).T @ flat
    grads[d + "b"] += flat.sum(axis=0)
    return dz @ w[d + "x"].T


@dataclass
class Model:
    """The trained tables: path and word vectors, statistics, two LSTMs and the last unit."""

    w: dict[str, np.ndarray]

    def scores(self, inputs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log-odds over (time, page) from the blocks' summed vectors."""
        x = np.tanh(inputs)
        ahead, _ = _lstm(x, self.w, "f", False)
        back, _ = _lstm(_reversed(x, lengths), self.w, "r", False)
        return np.concatenate([ahead, _reversed(back, lengths), x], axis=2) @ self.w["v"] + self.w["c"]


def _fresh(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def table(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    w = {
        "path": table(B.PATH_BUCKETS, K, scale=0.3), "word": table(B.WORD_BUCKETS, K, scale=0.1),
        "stat": table(B.STATISTICS, K, scale=0.3), "b": np.zeros(K, np.float32),
        "v": table(2 * H + K, scale=0.2), "c": np.zeros(1, np.float32),
    }
    for d in "fr":
        w[d + "x"], w[d + "h"] = table(K, 4 * H, scale=0.2), table(H, 4 * H, scale=0.2)
        w[d + "b"] = np.zeros(4 * H, np.float32)
        w[d + "b"][H : 2 * H] = 1
    return w


def _word_share(words: B.WordBuckets, text: str) -> np.ndarray:
    """The hashed words of a text, of length one however often a word is repeated."""
    rows = words.of(text)
    return np.sqrt(np.bincount(rows, minlength=B.WORD_BUCKETS).astype(np.float32) / max(1, len(rows)))


def _encoded(page: list[B.Block], words: B.WordBuckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    path = np.array([block.path for block in page], np.float32)
    path[np.arange(len(page)), list(B.leaf_tokens(page))] += 1
    return path, np.array([_word_share(words, block.text) for block in page]), B.statistics(page)


def train(examples: list[tuple[list[B.Block], np.ndarray]], seed: int = 1) -> Model:
    """A model of pages (blocks whose paths are bags of buckets) with the label of each block."""
    rng = np.random.default_rng(seed)
    w = _fresh(rng)
    words = B.WordBuckets()
    encoded = [(*_encoded(page, words), labels.astype(np.float32)) for page, labels in examples if page]
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in w.items()}
    step, order = 0, np.array(sorted(range(len(encoded)), key=lambda i: len(encoded[i][3])))
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    total = EPOCHS * len(batches)
    for _ in range(EPOCHS):
        for number in rng.permutation(len(batches)):
            chosen = [encoded[i] for i in batches[number]]
            lengths = np.array([len(page[3]) for page in chosen])
            padded = []
            for part in range(4):
                shape = chosen[0][part].shape[1:]
                block = np.zeros((lengths.max(), len(chosen), *shape), np.float32)
                for i, page in enumerate(chosen):
                    block[: lengths[i], i] = page[part]
                padded.append(block)
            path, word, stat, labels = padded
            # Words say less than places: now and then they are not shown.
            word = word * (rng.random((1, len(chosen), 1)) < 0.5)
            step += 1
            rate = RATE * (1 - 0.95 * step / total)
            grads = _gradients(w, path, word.astype(np.float32), stat, labels, lengths)
            for name, grad in grads.items():
                first, second = moments[name]
                first += 0.1 * (grad - first)
                second += 0.01 * (grad * grad - second)
                scale = rate / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
                w[name] -= scale * first
    return Model(w)


def _gradients(w, path, word, stat, labels, lengths) -> dict[str, np.ndarray]:
    grads = {name: np.zeros_like(value) for name, value in w.items()}
    seen = (np.arange(len(labels))[:, None] < lengths).astype(np.float32)
    x = np.tanh(path @ w["path"] + word @ w["word"] + stat @ w["stat"] + w["b"])
    turned = _reversed(x, lengths)
    ahead, kept_f = _lstm(x, w, "f", True)
    back, kept_r = _lstm(turned, w, "r", True)
    joined = np.concatenate([ahead, _reversed(back, lengths), x], axis=2)
    error = (_sigmoid(joined @ w["v"] + w["c"]) - labels) * seen / seen.sum()
    grads["v"] += np.einsum("tb,tbk->k", error, joined)
    grads["c"] += error.sum()
    dj = error[:, :, None] * w["v"]
    dx = dj[:, :, 2 * H :] + _lstm_gradient(x, kept_f, dj[:, :, :H], w, "f", grads)
    dx = dx + _reversed(_lstm_gradient(turned, kept_r, _reversed(dj[:, :, H : 2 * H], lengths), w, "r", grads), lengths)
    dz = (dx * (1 - x * x) * seen[:, :, None]).reshape(-1, K)
    for name, given in (("path", path), ("word", word), ("stat", stat)):
        grads[name] += given.reshape(-1, given.shape[2]).T @ dz
    grads["b"] += dz.sum(axis=0)
    return grads


# ---- training data ----------------------------------------------------------


class _Tags(B.Vectors):
    """Instead of vectors, remembers by which elements a block is surrounded."""

    KNOWN_OTHER = {w for kind in NAMES if kind not in ("main", "wrap") for n in NAMES[kind].split() for w in n.split("-")}

    def __init__(self) -> None:
        super().__init__(np.zeros((1, 1)))

    def of(self, tag: str, rest: str) -> np.ndarray:
        tokens = B.path_tokens(tag, rest)
        if tag in PLAIN_OTHER or any(t[1:] in self.KNOWN_OTHER for t in tokens[1:]):
            return np.array([-1e6])
        return np.array([1.0 if tag in PLAIN_MAIN else 0.0])


def _told_apart(page: str) -> list[tuple[str, int | None]]:
    """Texts of a page with the label that its markup plainly gives."""
    return [
        (block.text, 0 if block.path[0] < 0 else 1 if block.path[0] > 0 else None) for block in B.blocks(page, _Tags())
    ]


def training_pages(sample: list[str], seed: int = 1) -> list[tuple[list[B.Block], np.ndarray]]:
    """Layouts of the sample's texts, and those pages of it whose markup is plain."""
    bags = B.Vectors(np.eye(B.PATH_BUCKETS, dtype=np.float32))
    main, other, examples = [], [], []
    for page in sample:
        told = _told_apart(page)
        main += [text for text, label in told if label == 1]
        other += [text for text, label in told if label == 0]
        if told and None not in {label for _, label in told}:
            examples.append((B.blocks(page, bags), np.array([label for _, label in told])))
    if not main:
        # Nothing is marked as an article: long texts stand in for one.
        texts = [text for page in sample for text, _ in _told_apart(page)]
        main = [text for text in texts if len(text) > 80] or texts or ["Some text, of a few words."]
    layouts = Layouts(sorted(set(main)), sorted(set(other)), seed)
    for _ in range(LAYOUTS):
        page = B.blocks(layouts.page(), bags)
        labels = np.array([MAIN in block.text for block in page])
        for block in page:
            block.text = block.text.replace(MAIN, "").replace(OTHER, "").strip() or "x"
        examples.append((page, labels))
    return examples


def fit(pages: DataFrame, seed: int = 1) -> Model:
    """A model trained on the texts of a bounded sample of the pages."""
    usable = pages.where(f"length(html) BETWEEN 1 AND {LONGEST}").select(F.xxhash64("page_id", "url").alias("place"), "html")
    last = usable.select("place").distinct().orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]
    # Pages sent to the driver are at most SAMPLE: repeated ones count once.
    chosen = usable.where(F.col("place") <= F.lit(last)).groupBy("place").agg(F.min("html").alias("html")).orderBy("place")
    return train(training_pages([row.html for row in chosen.collect()], seed), seed)


# ---- extraction -------------------------------------------------------------


def _inputs(page: list[B.Block], w: dict[str, np.ndarray], words: B.WordBuckets) -> np.ndarray:
    """The summed vectors of a page's blocks."""
    out = np.array([block.path for block in page], np.float32)
    out += w["path"][list(B.leaf_tokens(page))] + B.statistics(page) @ w["stat"] + w["b"]
    for at in range(0, len(page), BLOCKS_AT_ONCE):
        part = page[at : at + BLOCKS_AT_ONCE]
        out[at : at + len(part)] += np.array([_word_share(words, block.text) for block in part]) @ w["word"]
    return out


def labelled(pages: list[str], model: Model, vectors: B.Vectors, words: B.WordBuckets) -> Iterator[tuple[int, list[B.Block], np.ndarray]]:
    """(number of the page, its blocks, their log-odds), pages of about equal length together."""
    # Parsed are never more pages than a batch of sequences may hold.
    waiting: list[tuple[int, list[B.Block]]] = []
    held = 0

    def run() -> Iterator[tuple[int, list[B.Block], np.ndarray]]:
        waiting.sort(key=lambda entry: len(entry[1]))
        while waiting:
            longest = len(waiting[-1][1])
            take = max(1, min(len(waiting), CELLS // longest))
            part = waiting[-take:]
            del waiting[-take:]
            lengths = np.array([len(blocks) for _, blocks in part])
            inputs = np.zeros((longest, len(part), K), np.float32)
            for i, (_, blocks) in enumerate(part):
                inputs[: lengths[i], i] = _inputs(blocks, model.w, words)
            scores = model.scores(inputs, lengths)
            for i, (number, blocks) in enumerate(part):
                yield number, blocks, scores[: lengths[i], i]

    for number, page in enumerate(pages):
        blocks = B.blocks(page, vectors)
        if not blocks:
            yield number, blocks, np.zeros(0)
            continue
        waiting.append((number, blocks))
        held += len(blocks)
        if held >= CELLS:
            yield from run()
            held = 0
    yield from run()


def _extract(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, words = B.Vectors(model.w["path"]), B.WordBuckets()
        limit = np.log(THRESHOLD / (1 - THRESHOLD))
        for batch in batches:
            pages = [page or "" for page in batch.column("html").to_pylist()]
            texts, kept, seen = [""] * len(pages), [0] * len(pages), [0] * len(pages)
            for number, blocks, scores in labelled(pages, model, vectors, words):
                main = [block.text for block, score in zip(blocks, scores, strict=True) if score > limit]
                texts[number], kept[number], seen[number] = "\n\n".join(main), len(main), len(blocks)
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(kept, pa.int64()), pa.array(seen, pa.int64())],
                ["page_id", "url", "text", "n_main", "n_blocks"],
            )

    return extract


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_main, n_blocks`` for each page."""
    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return given.mapInArrow(_extract(model), "page_id long, url string, text string, n_main long, n_blocks long")
