"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A text is cut into pieces by the vocabulary's pattern and each piece is merged
on its own. Leaf p of a piece's tree holds the rank of the pair that starts at
byte position p (rank and position in one number, so that the smallest number
is the leftmost pair of lowest rank); the root is the next merge. A merge
changes three leaves: the pair that begins at the merged token, the one before
it, and the swallowed one, each with a logarithmic number of updates towards
the root. ``merge_pieces`` does this for many pieces of one size class in step
with array operations, ``merge_piece`` for one long piece.

Spark partitions the documents; a task streams over Arrow batches and keeps a
bounded cache of chunks (see ``chunks``) between tasks.

Texts are cut into chunks, each encoded once, only for patterns that are known
to cut there too (``CUT_PATTERNS``); with any other pattern a text is encoded
whole.

Results for special inputs: a null text is an empty one (no ids, the hash of
no bytes); repeated rows each get their row; an empty table gives an empty
result; texts of any length are encoded whole; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.chunks import ChunkedEncoder, in_batches
from sparkfit.llm.common import ship, slices_by_bytes
from sparkfit.llm.vocab import once_per_process, shared_file

KEPT_CHUNKS = 150_000               # of a generation of the chunk cache
LONG_PIECE = 512                    # bytes; longer pieces are merged one by one
NEVER = np.int64(1) << np.int64(62)

# Fixed value: patterns that end a piece before a blank with something else behind
# it, around a line feed between other characters, and before , and . behind a letter.
CUT_PATTERNS = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
}


class Ranks:
    """A rank vocabulary: bytes of a token -> its id, which is its merge rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for each byte")
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # Every way to put a token together from two others: (left, right) -> token.
        pairs = {}
        for token, i in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The pairs as a dict, for merging single pieces; built when one comes."""
        return dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))

    @classmethod
    def parse(cls, content: bytes, pattern: str) -> Ranks:
        """From the lines of a rank file: base64 of the token, blank, rank."""
        rows = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in rows}, pattern)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NEVER)


def merge_piece(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of one piece; the tree is a list with the root at 1."""
    n = len(piece)
    ids = [int(i) for i in ranks.of_byte[np.frombuffer(piece, dtype=np.uint8)]]
    if n < 2:
        return ids
    never, pairs = (1 << 62, 0), ranks.pairs
    size = 1 << (n - 2).bit_length()
    tree = [never] * (2 * size)
    for p in range(n - 1):
        rank = pairs.get(ids[p] << 32 | ids[p + 1])
        if rank is not None:
            tree[size + p] = (rank, p)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after, before, live = list(range(1, n + 1)), list(range(-1, n)), [True] * n

    def put(p: int, value: tuple[int, int]) -> None:
        i = size + p
        tree[i] = value
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                break
            tree[i] = low

    def pair(p: int) -> tuple[int, int]:
        q = after[p]
        rank = pairs.get(ids[p] << 32 | ids[q]) if q < n else None
        return never if rank is None else (rank, p)

    while tree[1] != never:
        rank, p = tree[1]
        q = after[p]
        ids[p], live[q], after[p] = rank, False, after[q]
        if after[q] < n:
            before[after[q]] = p
        if q < n - 1:
            put(q, never)
        if p < n - 1:
            put(p, pair(p))
        if before[p] >= 0:
            put(before[p], pair(before[p]))
    return [i for i, alive in zip(ids, live, strict=True) if alive]


def _merge_class(pieces: list[bytes], width: int, ranks: Ranks) -> list[bytes]:
    """Pieces of 2 to ``width`` bytes, in step; width is a power of two."""
    n, bits = len(pieces), width.bit_length() - 1
    lens = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
    inside = np.arange(width) < lens[:, None]
    ids = np.zeros((n, width + 1), dtype=np.int64)
    ids[:, :-1][inside] = ranks.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
    live = inside.copy()
    tree = np.full((n, 2 * width), NEVER, dtype=np.int64)
    place = np.arange(width - 1)
    rank = ranks.pair_ranks(ids[:, :width - 1], ids[:, 1:width])
    paired = inside[:, 1:] & (rank < NEVER)
    tree[:, width:2 * width - 1] = np.where(paired, rank << np.int64(bits) | place, NEVER)
    step = width
    while step > 1:
        step >>= 1
        tree[:, step:2 * step] = np.minimum(tree[:, 2 * step:4 * step:2], tree[:, 2 * step + 1:4 * step:2])
    rows = np.flatnonzero(tree[:, 1] < NEVER)
    while len(rows):
        least = tree[rows, 1]
        p = least & np.int64(width - 1)
        ids[rows, p] = least >> np.int64(bits)
        q = after[rows, p]
        beyond = after[rows, q]
        after[rows, p] = beyond
        before[rows, beyond] = p                    # column `width` takes those past the end
        live[rows, q] = False
        end = lens[rows]
        own = np.where(beyond < end, ranks.pair_ranks(ids[rows, p], ids[rows, np.minimum(beyond, width)]), NEVER)
        tree[rows, width + p] = np.where(own < NEVER, own << np.int64(bits) | p, NEVER)
        tree[rows, width + q] = NEVER
        b = before[rows, p]
        has = b >= 0
        b = np.where(has, b, p)
        left = np.where(has, ranks.pair_ranks(ids[rows, b], ids[rows, p]), NEVER)
        old = tree[rows, width + b]
        tree[rows, width + b] = np.where(has, np.where(left < NEVER, left << np.int64(bits) | b, NEVER), old)
        r3 = np.concatenate([rows, rows, rows])
        node = np.concatenate([p, q, b]) + width
        for _ in range(bits):
            node >>= 1
            tree[r3, node] = np.minimum(tree[r3, 2 * node], tree[r3, 2 * node + 1])
        rows = rows[tree[rows, 1] < NEVER]
    flat = ids[:, :-1][live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(axis=1)) * 4
    starts = np.concatenate([[0], ends[:-1]])
    return [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def merge_pieces(pieces: list[bytes], ranks: Ranks) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of each piece."""
    out: list[bytes | None] = [None] * len(pieces)
    classes: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        whole = ranks.ranks.get(piece)
        if whole is not None:
            out[i] = whole.to_bytes(4, "little")
        elif not piece:
            out[i] = b""
        elif len(piece) > LONG_PIECE:
            out[i] = np.array(merge_piece(piece, ranks), dtype="<u4").tobytes()
        else:
            classes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for width, members in classes.items():
        run = max(1, (1 << 17) // width)            # rows of some 10 MB of working arrays
        for a in range(0, len(members), run):
            part = members[a:a + run]
            for i, ids in zip(part, _merge_class([pieces[i] for i in part], width, ranks), strict=True):
                out[i] = ids
    return out  # type: ignore[return-value]


class Codec:
    """Encoding and decoding of whole texts."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.encoder = ChunkedEncoder(lambda cs: in_batches(cs, self._chunks, 1 << 18, 1 << 14), limit=KEPT_CHUNKS) \
            if ranks.pattern.pattern in CUT_PATTERNS else None
        top = max(ranks.tokens) + 1
        self.tokens = [ranks.tokens.get(i, b"") for i in range(top)]

    @classmethod
    def parse(cls, content: bytes, pattern: str) -> Codec:
        return cls(Ranks.parse(content, pattern))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self.ranks.pattern.findall(c) if not self.ranks.pattern.groups
               else [m.group() for m in self.ranks.pattern.finditer(c)] for c in chunks]
        distinct = list({piece for pieces in cut for piece in pieces})
        ids = dict(zip(distinct, merge_pieces([d.encode() for d in distinct], self.ranks), strict=True))
        return [b"".join([ids[piece] for piece in pieces]) for pieces in cut]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text; a null text is an empty one."""
        if self.encoder is None:
            whole = in_batches(texts.fill_null("").to_pylist(), self._chunks)
            return [np.frombuffer(x, dtype="<u4") for x in whole]
        ids, counts = self.encoder(texts)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def with_codec(docs: DataFrame, vocabulary: str, pattern: str, text_col: str, carried: list[str],
               fields: str, digest) -> DataFrame:
    """Rows (*carried, *fields): ``digest(codec, Arrow texts) -> arrays`` over all
    documents. ``vocabulary`` is the rank file's path on the driver; its content
    (bounded) goes to the tasks with the function."""
    spark = docs.sparkSession
    ship(spark)
    shared = shared_file(spark, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once_per_process(shared.value, Codec.parse, pattern)
        for batch in batches:
            for part in slices_by_bytes(batch, "t"):
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *digest(own, part.column(0))], names=names)

    # Columns travel by place, so their names cannot clash.
    places = [f"c{i}" for i in range(len(carried))]
    rows = docs.select(F.col(text_col).alias("t"), *[F.col(c).alias(p) for c, p in zip(carried, places, strict=True)])
    types = dict(docs.dtypes)
    names = [*places, *[f.split()[0] for f in fields.split(", ")]]
    schema = ", ".join([*(f"{p} {types[c]}" for c, p in zip(carried, places, strict=True)), fields])
    return rows.mapInArrow(run, schema).toDF(*carried, *names[len(places):])


def _hexes(values: list) -> pa.Array:
    """SHA-256 of bytes, or of arrays' bytes (ids are little-endian)."""
    return pa.array([hashlib.sha256(x).hexdigest() for x in values], type=pa.string())


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, n_tokens, ids array<int>, ids_sha256, decoded_sha256) of
    every document's whole text."""
    def digest(own: Codec, texts: pa.Array) -> list[pa.Array]:
        ids = own.encode(texts)
        n = np.array([len(x) for x in ids], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        flat = pa.array(np.concatenate(ids).astype(np.int32))
        return [pa.array(n), pa.ListArray.from_arrays(pa.array(ends), flat), _hexes(ids),
                _hexes([own.decode(x) for x in ids])]
    return with_codec(docs, vocabulary, pattern, text_col, [id_col, *(keep or [])],
                      "n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string", digest)


def encode_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): hashes of the ids as
    little-endian unsigned 32-bit integers, and of the bytes decoded from them.
    Only the digests leave the task."""
    def digest(own: Codec, texts: pa.Array) -> list[pa.Array]:
        ids = own.encode(texts)
        return [pa.array([len(x) for x in ids], type=pa.int64()), _hexes(ids),
                _hexes([own.decode(x) for x in ids])]
    return with_codec(docs, vocabulary, pattern, text_col, [id_col],
                      "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)
