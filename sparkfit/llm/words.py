"""Words, shingles and their 64-bit hashes for whole batches of texts.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return; A-Z are lower-cased, nothing else is. Everything is
computed over the concatenated bytes of a batch with array operations, so the
cost is a few passes over the bytes and not a Python step per word.
"""

from __future__ import annotations

import numpy as np

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Odd 64-bit multipliers: of the polynomial over a word's bytes, and of the
# words of a shingle.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F,
                   0xEB44ACCAB455D165, 0x9FB21C651E98DF25], dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(64, 1 << (n - 1).bit_length())
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (each output bit depends on all input bits)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, first word of each text plus the end).

    ``texts`` are UTF-8 bytes; text i's words are hashes[first[i]:first[i+1]].
    Empty texts and texts of white space have no words.
    """
    n = len(texts)
    raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=n))
    word = _IS_WORD[raw]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    starts, stops = edge[0::2], edge[1::2]          # the last byte is white space
    first = np.zeros(n + 1, dtype=np.int64)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), first
    lens = stops - starts
    at = np.cumsum(lens) - lens                     # word starts among the word bytes
    body = raw[word].astype(np.uint64)
    body += np.uint64(1)
    place = np.arange(len(body), dtype=np.int64) - np.repeat(at, lens)
    body *= _powers_to(int(lens.max()))[place]
    h = mix(np.add.reduceat(body, at) + lens.astype(np.uint64) * _PLACE[7])
    first[1:] = np.searchsorted(starts, ends, side="left")
    return h, first


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of one text's shingles of ``size`` words in order, repeats kept;
    a text with fewer words is one shingle, a text without words has none."""
    k = min(size, len(words))
    if k == 0:
        return np.empty(0, dtype=np.uint64)
    n = len(words) - k + 1
    h = np.full(n, k, dtype=np.uint64) * _PLACE[6]
    for j in range(k):
        h += mix(words[j:j + n] + _PLACE[j % 6:j % 6 + 1] * np.uint64(j // 6 + 1)) * _PLACE[j % 6]
    return mix(h)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted."""
    h, first = word_hashes(texts)
    return [np.unique(shingle_hashes(h[a:b], size)) for a, b in zip(first[:-1], first[1:], strict=True)]
