"""Token ids of whole texts by way of their repeated chunks.

Most of a text is made of chunks that were seen before. A text is cut at
boundaries where a tokenizer cuts too, each distinct chunk is encoded once by
the tokenizer, and the text's ids are the chunks' ids in order. What a worker
process keeps between tasks is bounded: two generations of a fixed number of
chunks, the older one dropped when the younger one is full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import compress, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Before a blank with something other than white space behind it. Byte-level
# patterns give the blank to the piece behind it and end the piece before it.
BEFORE_BLANK = re.compile(r" (?=\S)")
# Stands for: at blanks and line feeds, for tokenizers that drop white space.
AT_BLANKS = "blanks"

MAX_CHUNKS = 300_000        # of a generation; about 60 MB with their ids
LONGEST_KEPT = 128          # code points; longer chunks are encoded every time
ENDINGS = ",."              # taken off words: a piece of letters ends before them


class ChunkCache:
    """chunk -> value, filled by ``encode(list of chunks) -> list of values``.

    ``endings``: value of each of ``ENDINGS`` alone. A chunk that ends with one
    behind an ASCII letter is then the chunk without it and the ending, so a
    word is encoded once whatever follows it.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = MAX_CHUNKS, endings: dict | None = None):
        self.encode, self.limit, self.endings = encode, limit, endings or {}
        self.young: dict = {}
        self.old: dict = {}
        self.passing: list[str] = []

    def resolve(self, chunks: Iterable[str]) -> dict:
        """A dict that has all of ``chunks``, valid until the next call."""
        for c in self.passing:
            self.young.pop(c, None)
        self.passing = []
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        new = self._recall(chunks)
        ended = [c for c in new if c[-1:] in self.endings and len(c) > 1 and c[-2].isascii() and c[-2].isalpha()]
        if ended:
            new = self._recall([*new.difference(ended), *[c[:-1] for c in ended]])
        fresh = list(new)
        self.young.update(zip(fresh, self.encode(fresh), strict=True))
        self.young.update([(c, self.young[c[:-1]] + self.endings[c[-1]]) for c in ended])
        self.passing = [c for c in (*fresh, *ended) if len(c) > LONGEST_KEPT]
        return self.young

    def _recall(self, chunks: Iterable[str]) -> set[str]:
        """Chunks that neither generation has; those of the old one are young again."""
        missing = set(filterfalse(self.young.__contains__, chunks))
        known = list(filter(self.old.__contains__, missing))
        self.young.update(zip(known, map(self.old.__getitem__, known), strict=True))
        missing.difference_update(known)
        return missing


def distinct_parts(cut: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first part of each row, number of every part, the distinct parts)."""
    offsets = cut.offsets.to_numpy()
    parts = cut.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    coded = pc.dictionary_encode(parts)
    return offsets[:-1] - offsets[0], coded.indices.to_numpy(), coded.dictionary


def as_list(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


class ChunkedEncoder:
    """Ids of Arrow arrays of texts.

    ``encode(strings) -> list of id bytes`` (little-endian unsigned 32-bit);
    ``encode_words`` the same for strings that all begin with a blank and go on
    with something else. A text is cut before its blanks, distinct chunks go
    through a cache, and the ids are gathered by arrays.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]],
                 encode_words: Callable[[list[str]], list[bytes]] | None = None, limit: int = MAX_CHUNKS):
        words, endings = encode_words or encode, dict(zip(ENDINGS, encode(list(ENDINGS)), strict=True))
        self.line_feed = encode(["\n"])[0]
        self.head = ChunkCache(encode, max(1, limit // 4), endings)
        self.tail = ChunkCache(lambda cs: words([" " + c for c in cs]), limit, endings)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text);
        a null text is an empty one."""
        if not len(texts):
            return np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        firsts, number, distinct = distinct_parts(pc.split_pattern(texts.fill_null(""), " "))
        words = as_list(distinct)
        heads = as_list(distinct.take(pa.array(number[firsts])))
        # A blank with white space behind it is no place to cut: texts that have
        # one are put together from regular cuts, as if they were one chunk.
        odd = pc.or_(pc.equal(pc.binary_length(distinct), 0),
                     pc.utf8_is_space(pc.utf8_slice_codeunits(distinct, 0, 1))).to_numpy(zero_copy_only=False)
        slow: dict[int, list[str]] = {}
        if odd.any():
            unsafe = odd[number]
            unsafe[firsts] = False
            for i in np.flatnonzero(np.logical_or.reduceat(unsafe, firsts)).tolist():
                heads[i], *slow[i] = BEFORE_BLANK.split(texts[i].as_py())
        # The last word of a line and the first of the next one hang together;
        # a line feed between other characters is a piece of its own.
        lined = pc.match_substring(distinct, "\n").to_numpy(zero_copy_only=False) & ~odd
        over = {w: w.split("\n") for w in [*compress(words, lined.tolist()),
                                           *[c for rest in slow.values() for c in rest if "\n" in c]]}
        over = {w: lines for w, lines in over.items()
                if not any(not x or x[0].isspace() or x[-1].isspace() for x in lines)}
        head = self.head.resolve([*heads, *[x for lines in over.values() for x in lines[1:]]])
        plain = compress(words, (~(odd | lined)).tolist())
        tail = self.tail.resolve([*plain, *[w for w in compress(words, lined.tolist()) if w not in over],
                                  *[c for rest in slow.values() for c in rest if c not in over],
                                  *[lines[0] for lines in over.values()]])
        joined = {w: self.line_feed.join([tail[lines[0]], *map(head.__getitem__, lines[1:])])
                  for w, lines in over.items()}
        values = list(map(tail.get, words))
        for i in np.flatnonzero(odd | lined).tolist():
            values[i] = b"" if odd[i] else joined[words[i]] if words[i] in joined else tail[words[i]]
        starting = list(map(head.__getitem__, heads))
        for i, rest in slow.items():
            starting[i] += b"".join([joined[c] if c in joined else tail[c] for c in rest])
        values += starting
        ids = np.frombuffer(b"".join(values), dtype="<u4")
        sizes = np.fromiter(map(len, values), dtype=np.int32, count=len(values)) >> 2
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        # The first chunk of a text stands for itself, or for the whole text.
        number = number.copy()
        last = np.append(firsts[1:], len(number))
        number[firsts] = len(words) + np.arange(len(firsts))
        taken = sizes[number]
        for i in slow:
            taken[firsts[i] + 1:last[i]] = 0
        before = np.cumsum(taken, dtype=np.int64) - taken
        at = np.repeat(starts[number] - before, taken)
        at += np.arange(len(at))
        return ids[at], np.add.reduceat(taken, firsts, dtype=np.int64)


def taken_at(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs of an array, one after the other."""
    before = np.cumsum(sizes, dtype=np.int64) - sizes
    at = np.repeat(starts - before, sizes)
    at += np.arange(len(at))
    return at


class IdStore:
    """Ids of strings as arrays: ``keys``, and for each its run in ``flat``.

    ``encode(strings) -> (ids, sizes)``; ``endings`` are those of ``ENDINGS``. A
    string that ends with one behind an ASCII letter is the string without it
    and the ending.
    What hasn't been asked for the longest goes when there are more than
    ``limit`` strings; those over ``LONGEST_KEPT`` go after each use.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
                 endings: tuple[np.ndarray, np.ndarray], limit: int):
        self.encode, self.endings, self.limit, self.clock = encode, endings, limit, 0
        self.keys = pa.array([], pa.string())
        self.flat, self.sizes, self.starts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.used = np.empty(0, np.int32)

    def _keep(self, keep: np.ndarray) -> None:
        self.flat = self.flat[taken_at(self.starts[keep], self.sizes[keep])]
        self.keys, self.sizes, self.used = self.keys.filter(pa.array(keep)), self.sizes[keep], self.used[keep]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _trim(self) -> None:
        long = pc.greater(pc.utf8_length(self.keys), LONGEST_KEPT).to_numpy(zero_copy_only=False)
        if len(self.keys) > self.limit:
            latest = np.partition(self.used, len(self.used) - self.limit // 2)[len(self.used) - self.limit // 2]
            self._keep(~long & (self.used >= latest))
        elif long.any():
            self._keep(~long)

    def _find(self, strings: pa.Array) -> np.ndarray:
        """Places of different strings among the keys; unknown ones are encoded."""
        found = pc.index_in(strings, value_set=self.keys)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = strings.take(pa.array(new))
            ids, sizes = self.encode(fresh)
            at[new] = len(self.keys) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, fresh])
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.flat = np.concatenate([self.flat, ids])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
        self.used[at] = np.maximum(self.used[at], self.clock)
        return at

    def ids(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings one after another, ids of each)."""
        self.clock += 1
        self._trim()
        ended = pc.match_substring_regex(strings, "[A-Za-z][,.]$")
        has = ended.to_numpy(zero_copy_only=False)
        if has.any():
            bare = pc.if_else(ended, pc.utf8_slice_codeunits(strings, 0, -1), strings)
            coded = pc.dictionary_encode(bare)
            at = self._find(coded.dictionary)[coded.indices.to_numpy()]
            last = pc.utf8_slice_codeunits(strings.filter(ended), -1)
            end = pc.index_in(last, value_set=pa.array(list(ENDINGS))).to_numpy(zero_copy_only=False)
            end_ids, end_sizes = self.endings
            sizes, starts = np.zeros((len(at), 2), np.int64), np.zeros((len(at), 2), np.int64)
            starts[:, 0], sizes[:, 0] = self.starts[at], self.sizes[at]
            starts[has, 1], sizes[has, 1] = (len(self.flat) + np.cumsum(end_sizes) - end_sizes)[end], end_sizes[end]
            flat = np.concatenate([self.flat, end_ids])
            return flat[taken_at(starts.reshape(-1), sizes.reshape(-1))], sizes.sum(axis=1)
        coded = pc.dictionary_encode(strings)
        at = self._find(coded.dictionary)[coded.indices.to_numpy()]
        return self.flat[taken_at(self.starts[at], self.sizes[at])], self.sizes[at]


class ArrayEncoder:
    """``ChunkedEncoder`` by arrays throughout, with an end id after each text.

    ``encode(strings)`` and ``encode_words(words)``, which are to be encoded with
    a blank before each, give (ids, ids of each string) for Arrow arrays.
    """

    def __init__(self, encode, encode_words, limit: int = MAX_CHUNKS):
        self.line_feed = encode(pa.array(["\n"]))[0]
        endings = encode(pa.array(list(ENDINGS)))
        self.heads = IdStore(encode, endings, limit)
        self.tails = IdStore(encode_words, endings, 2 * limit)

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids of each text); a null text is
        an empty one."""
        if not len(texts):
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
        firsts, number, distinct = distinct_parts(pc.split_pattern(texts.fill_null(""), " "))
        n = len(distinct)
        odd = pc.or_(pc.equal(pc.binary_length(distinct), 0),
                     pc.utf8_is_space(pc.utf8_slice_codeunits(distinct, 0, 1))).to_numpy(zero_copy_only=False)
        heads = distinct.take(pa.array(number[firsts]))
        slow: dict[int, list[str]] = {}
        if odd.any():
            unsafe = odd[number]
            unsafe[firsts] = False
            for i in np.flatnonzero(np.logical_or.reduceat(unsafe, firsts)).tolist():
                slow[i] = BEFORE_BLANK.split(texts[i].as_py())
        lined = pc.match_substring(distinct, "\n").to_numpy(zero_copy_only=False) & ~odd
        tail_strings, head_strings = [], []         # beyond the plain words and the heads of texts

        def parts_of(chunk: str) -> list[tuple[int, int]]:
            """(kind, place) of the strings that a chunk after a blank consists of:
            0 a tail, 1 a head, 2 a line feed."""
            lines = chunk.split("\n")
            if len(lines) == 1 or any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
                lines = [chunk]
            out = [(0, len(tail_strings))]
            tail_strings.append(lines[0])
            for x in lines[1:]:
                out += [(2, 0), (1, len(head_strings))]
                head_strings.append(x)
            return out

        # What is made of several strings: words with line feeds, then texts with odd blanks.
        made = [parts_of(w) for w in as_list(distinct.filter(pa.array(lined)))]
        for i, (first, *rest) in slow.items():
            made.append([(1, len(head_strings)), *[p for c in rest for p in parts_of(c)]])
            head_strings.append(first)

        plain = ~(odd | lined)
        tails, tail_sizes = self.tails.ids(pa.concat_arrays([distinct.filter(pa.array(plain)),
                                                             pa.array(tail_strings, pa.string())]))
        starting, head_sizes = self.heads.ids(pa.concat_arrays([heads, pa.array(head_strings, pa.string())]))
        flat = np.concatenate([tails, starting, self.line_feed])
        tail_starts = np.cumsum(tail_sizes) - tail_sizes
        head_starts = len(tails) + np.cumsum(head_sizes) - head_sizes
        n_plain, n_texts = int(plain.sum()), len(heads)
        starts, sizes = np.zeros(n + n_texts, np.int64), np.zeros(n + n_texts, np.int64)
        starts[:n][plain], sizes[:n][plain] = tail_starts[:n_plain], tail_sizes[:n_plain]
        starts[n:], sizes[n:] = head_starts[:n_texts], head_sizes[:n_texts]
        if made:
            kind = np.array([k for m in made for k, _ in m])
            place = np.array([p for m in made for _, p in m])
            per = np.array([len(m) for m in made])
            own_starts, own_sizes = np.full(len(kind), len(tails) + len(starting)), np.full(len(kind), len(self.line_feed))
            for k, base, s, z in ((0, n_plain, tail_starts, tail_sizes), (1, n_texts, head_starts, head_sizes)):
                of = kind == k
                own_starts[of], own_sizes[of] = s[base + place[of]], z[base + place[of]]
            joined = flat[taken_at(own_starts, own_sizes)]
            total = np.add.reduceat(own_sizes, np.cumsum(per) - per)
            to = np.concatenate([np.flatnonzero(lined), n + np.array(list(slow), np.int64)])
            starts[to], sizes[to] = len(flat) + np.cumsum(total) - total, total
            flat = np.concatenate([flat, joined])
        # The first chunk of a text stands for itself, or for the whole text; the end id follows the last.
        number = number.astype(np.int64)
        last = np.append(firsts[1:], len(number))
        number[firsts] = n + np.arange(n_texts)
        starts, sizes = np.append(starts, [0, len(flat)]), np.append(sizes, [0, 1])
        for i in slow:
            number[firsts[i] + 1:last[i]] = n + n_texts
        number = np.insert(number, last, n + n_texts + 1)
        taken = sizes[number]
        ids = np.append(flat, np.array([end_id], flat.dtype))[taken_at(starts[number], taken)]
        return ids, np.add.reduceat(taken, firsts + np.arange(n_texts), dtype=np.int64)


def in_batches(strings: list[str], encode: Callable[[list[str]], list], target: int = 1 << 18,
               longest: int = 4096) -> list:
    """``encode`` over runs of about ``target`` characters (``longest`` strings
    at most), so that a call's memory is bounded whatever the chunks hold."""
    out: list = []
    run: list[str] = []
    held = 0
    for s in strings:
        if run and (held + len(s) > target or len(run) >= longest):
            out += encode(run)
            run, held = [], 0
        run.append(s)
        held += len(s)
    if run:
        out += encode(run)
    return out
