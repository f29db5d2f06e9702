"""Pages as sequences of leaf blocks: the text of each, and what its place in the markup says.

The parser repairs what pages usually leave out (end tags of paragraphs, list items and table
cells, quotes, the end of the page) and never fails.  A block is the text between two
boundaries of block elements.  Elements add the vectors of their tag and of the words in
their class, id and role to those of the elements around them, the nearer the more; that sum
is the block's path vector, however deep elements are nested.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Elements without text of the page, elements that begin and end a block,
# elements whose start ends an open one of the same kind, and where such a search stops.
UNSEEN = (
    "script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "math", "noembed", "noframes", "xmp",
)
BLOCKS = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
EMPTY = frozenset(["hr"])
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
}
HIDDEN = re.compile(r"display\s*:\s*none|\bhidden\b|aria-hidden\s*=\s*\W?true", re.I)

PIECES = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<unseen>{'|'.join(UNSEEN)})\b[^>]*+>.*?(?:</(?P=unseen)\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?(?P<torn>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)",
    re.I | re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORDS = re.compile(r"\w+")

PATH_BUCKETS = WORD_BUCKETS = 512
# How much of what the elements around say reaches the elements within.
INHERITED = 0.9
STATISTICS = 9


def bucket(token: str, buckets: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % buckets


def path_tokens(tag: str, rest: str) -> list[str]:
    """What an element says of its content: its tag, and the words it is named by."""
    tokens = [tag]
    for groups in NAMES.findall(rest):
        tokens += ["." + word.lower() for word in NAME_WORDS.findall("".join(groups))]
    if HIDDEN.search(rest):
        tokens.append(".hidden")
    return tokens


@dataclass
class Block:
    text: str
    tag: str
    path: np.ndarray
    linked: int


class Vectors:
    """Vectors of start tags, kept for those seen last."""

    KEPT = 20_000

    def __init__(self, table: np.ndarray):
        self.table = table
        self.known: dict[tuple[str, str], np.ndarray] = {}

    def of(self, tag: str, rest: str) -> np.ndarray:
        found = self.known.get((tag, rest))
        if found is None:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            rows = [bucket(token, len(self.table)) for token in path_tokens(tag, rest)]
            found = self.known[tag, rest] = self.table[rows].sum(axis=0)
        return found


def blocks(page: str, vectors: Vectors) -> list[Block]:
    """The blocks of a page that have text, in order."""
    found: list[Block] = []
    stack: list[tuple[str, np.ndarray]] = [("", np.zeros(vectors.table.shape[1], vectors.table.dtype))]
    open_tags: dict[str, int] = {}
    texts: list[str] = []
    links = linked = 0

    def finish() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(texts)).split())
        if text:
            found.append(Block(text, stack[-1][0], stack[-1][1], linked))
        texts.clear()
        linked = 0

    def leave() -> str:
        tag, _ = stack.pop()
        open_tags[tag] -= 1
        return tag

    at = 0
    for piece in PIECES.finditer(page):
        if piece.start() > at:
            texts.append(page[at : piece.start()])
            if links:
                linked += piece.start() - at
        at = piece.end()
        tag = (piece["tag"] or piece["torn"] or "").lower()
        ending = page.startswith("</", piece.start())
        if tag == "br":
            texts.append(" ")
        elif tag == "a":
            links = 0 if ending else 1
        if tag not in BLOCKS:
            continue
        finish()
        if ending:
            if open_tags.get(tag):
                while leave() != tag:
                    pass
                links = 0
            continue
        # Every block element ends a paragraph, so an open one is the last.
        if stack[-1][0] == "p":
            leave()
        ends, stops = ENDS.get(tag, ((), ()))
        if any(open_tags.get(t) for t in ends):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in stops:
                    break
                if stack[depth][0] in ends:
                    while len(stack) > depth:
                        leave()
                    break
        if tag not in EMPTY:
            stack.append((tag, stack[-1][1] * INHERITED + vectors.of(tag, piece["rest"] or "")))
            open_tags[tag] = open_tags.get(tag, 0) + 1
    texts.append(page[at:])
    finish()
    return found


def statistics(page: list[Block]) -> np.ndarray:
    """Length, links, marks and place of each block."""
    rows = np.zeros((len(page), STATISTICS), np.float32)
    for i, block in enumerate(page):
        text, n = block.text, len(block.text)
        rows[i] = (
            np.log1p(n) / 5, min(1.0, block.linked / n), np.log1p(text.count(" ")) / 4,
            10 * (text.count(".") + text.count(",")) / (n + 10), text[-1] in ".!?…\"'”)", text[0].isupper(),
            "©" in text, 1 / (1 + i), 1 / (len(page) - i),
        )
    return rows


class WordBuckets(dict):
    """Words and their buckets, kept for those seen last."""

    KEPT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        found = self[word] = bucket(word, WORD_BUCKETS)
        return found

    def of(self, text: str) -> list[int]:
        return [self[word] for word in WORDS.findall(text.lower())]


def leaf_tokens(page: list[Block]) -> Iterator[int]:
    """The bucket of the element right around each block."""
    return (bucket("leaf " + block.tag, PATH_BUCKETS) for block in page)
