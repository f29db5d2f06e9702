"""Word shingles as sorted sets of 64-bit hashes, computed over whole buffers at once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5

# Bytes that are dealt with at a time; a longer text is cut between words.
PIECE = 1 << 22

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x + _MULTIPLIER
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_OF_BYTE = mixed(np.arange(256, dtype=np.uint64) + _U(1 << 20))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and hash of each word of a buffer; A-Z count as a-z."""
    inside = ~_BLANK[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, lengths, np.empty(0, np.uint64)
    powers = np.ones(int(lengths.max()), np.uint64)
    np.cumprod(np.full(len(powers) - 1, _MULTIPLIER), out=powers[1:])
    where = np.flatnonzero(inside)
    firsts = np.cumsum(lengths) - lengths
    offsets = np.arange(len(where)) - np.repeat(firsts, lengths)
    values = _OF_BYTE[_LOWER[raw[where]]] * powers[offsets]
    return starts, lengths, mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, hash and text number of each word; text i is from bounds[i] to bounds[i + 1].

    Long buffers are dealt with in pieces that end at blanks.
    """
    # A blank before each text, so that no word runs over.
    spaced = np.insert(raw, bounds[:-1], 0x20)
    found, at = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))], 0
    while at < len(spaced):
        end = min(at + PIECE, len(spaced))
        while end < len(spaced):
            more = np.flatnonzero(_BLANK[spaced[end : end + PIECE]])
            if len(more):
                end += int(more[0])
                break
            end = min(end + PIECE, len(spaced))
        starts, lengths, hashes = _word_hashes(spaced[at:end])
        found.append((starts + at, lengths, hashes))
        at = end
    starts, lengths, hashes = (np.concatenate(column) for column in zip(*found, strict=True))
    text = np.searchsorted(bounds[:-1] + np.arange(len(bounds) - 1), starts, "right") - 1
    return starts - text - 1, lengths, hashes, text


def _sets(
    raw: np.ndarray, bounds: np.ndarray, score: Callable[[np.ndarray], np.ndarray] | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    _, _, hashes, text = words_of(raw, bounds)
    at = np.searchsorted(text, np.arange(len(bounds)))
    n = max(len(hashes) - WIDTH + 1, 0)
    rolled = np.full(n, _U(WIDTH))
    for k in range(WIDTH):
        rolled = rolled * _MULTIPLIER + hashes[k : k + n]
    rolled = mixed(rolled)
    sums = np.concatenate([[0], np.cumsum(score(hashes))]) if score else None
    none = np.empty(0, np.int64)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= WIDTH:
            found, first = np.unique(rolled[a : b - WIDTH + 1], return_index=True)
            yield found, sums[a + first + WIDTH] - sums[a + first] if score else none, hashes[a:b]
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = whole * _MULTIPLIER + h
            yield mixed(whole), np.array([sums[b] - sums[a]]) if score else none, hashes[a:b]
        else:
            yield np.empty(0, np.uint64), none, hashes[a:b]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; NULL is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), bounds


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text; none for NULL and for texts without words."""
    return (found for found, _, _ in scored_sets(texts))


def scored_sets(
    texts: pa.Array, score: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text its sorted shingle hashes, the sum of each shingle's word scores, and its words' hashes."""
    raw, bounds = text_buffer(texts)
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1, at + 1)
        yield from _sets(raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], score)
        at = to


def digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
