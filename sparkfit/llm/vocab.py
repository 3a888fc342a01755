"""Tokenizer files for the tasks, and where texts may be cut for them.

The content of a tokenizer file is bounded and goes to the tasks as a broadcast
variable; each worker process builds the tokenizer once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

from sparkfit.llm.chunks import AT_BLANKS, BEFORE_BLANK, in_batches
from sparkfit.llm.common import check_bound

MAX_FILE_BYTES = 64 << 20

# Fixed value: the split pattern of word-level files whose matches never hold
# white space; what lies between matches is dropped.
WORDS_ONLY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Normalizers that change nothing across white space.
LOCAL_NORMALIZERS = {"NFC", "Lowercase"}


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """The file's content for every task; ``path`` is read on the driver."""
    with open(path, "rb") as f:
        content = f.read()
    check_bound("bytes of the tokenizer file", len(content), MAX_FILE_BYTES)
    return spark.sparkContext.broadcast(content)


def _is_local(normalizer: dict | None) -> bool:
    if normalizer is None:
        return True
    if normalizer["type"] == "Sequence":
        return all(map(_is_local, normalizer["normalizers"]))
    if normalizer["type"] == "Replace":
        return normalizer["pattern"] == {"Regex": r"\s+"} and normalizer["content"] == " "
    return normalizer["type"] in LOCAL_NORMALIZERS


def safe_cut(spec: dict) -> re.Pattern | str | None:
    """Where texts can be cut without changing a token, or None if that isn't
    known: then texts are encoded whole. Tokens added to the vocabulary must
    not hold or absorb white space."""
    for token in spec.get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(r"\s", token["content"]):
            return None
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") == "ByteLevel":
        plain = spec.get("normalizer") is None and pre["use_regex"] and not pre["add_prefix_space"]
        return BEFORE_BLANK if plain else None
    if pre.get("type") == "Sequence" and _is_local(spec.get("normalizer")):
        split, *rest = pre["pretokenizers"]
        words = split.get("type") == "Split" and split["pattern"] == {"Regex": WORDS_ONLY} \
            and split["behavior"] == "Removed" and split["invert"]
        inner = all(r["type"] == "ByteLevel" and not r["use_regex"] and not r["add_prefix_space"] for r in rest)
        return AT_BLANKS if words and inner else None
    return None


def _runs(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal labels."""
    if not len(labels):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    return np.concatenate([[0], cuts]), np.append(cuts, len(labels))


class LibraryTokenizer:
    """The tokenizers library on batches of strings, without special tokens
    around them; special strings inside are treated as the library does."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(content)
        self.cut = safe_cut(spec)
        if self.cut is BEFORE_BLANK:
            # Bytes of each token: a character of a byte-level token is a byte.
            sizes = {i: len(t) for t, i in spec["model"]["vocab"].items()} \
                | {t["id"]: len(t["content"].encode()) for t in spec.get("added_tokens") or []}
            self.sizes = np.zeros(max(sizes) + 1, dtype=np.int64)
            self.sizes[list(sizes)] = list(sizes.values())

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of strings that each begin with a blank and something behind it:
        encoded as one string, since no token goes over such a blank, and taken
        apart again by the tokens' bytes."""
        if not words:
            return []
        found = self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype="<u4")
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), dtype=np.int64, count=len(words)))
        upto = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(upto, ends)
        if len(upto) <= int(cuts[-1]) or (upto[cuts] != ends).any():
            return self.ids(words)
        raw, cuts = ids.tobytes(), [0, *((cuts + 1) * 4).tolist()]
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def word_arrays(self, words: pa.Array, target: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """``word_ids`` of an Arrow array of words without their blanks, as (ids,
        ids of each), in calls of about ``target`` bytes."""
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        call = np.cumsum(sizes) // target
        out, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for a, b in zip(*(x.tolist() for x in _runs(call)), strict=True):
            part = words.slice(a, b - a)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), part), " ")[0].as_py()
            ids = np.array(self.tokenizer.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(sizes[a:b])
            upto = np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(upto, ends)
            if len(upto) <= int(cuts[-1]) or (upto[cuts] != ends).any():
                ids, own = self.arrays(pa.array([" " + w for w in part.to_pylist()], pa.string()))
            else:
                own = np.diff(cuts + 1, prepend=0)
            out.append(ids)
            counts.append(own)
        return np.concatenate(out), np.concatenate(counts)

    def arrays(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of an Arrow array of strings."""
        found = in_batches(strings.to_pylist(), self.ids)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        return np.frombuffer(b"".join(found), dtype="<i4"), sizes

    def ids(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def counts(self, strings: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]


class PieceTokenizer:
    """The sentencepiece library, for .model files; texts are encoded whole."""

    cut = None

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor
        self.processor = SentencePieceProcessor(model_proto=content)

    def counts(self, strings: list[str]) -> list[int]:
        return list(map(len, self.processor.encode(strings, num_threads=1)))


_built: dict = {}


def once_per_process(content: bytes, build: Callable, *more: str):
    """``build(content, *more)``, kept by the worker process until another one
    is asked for."""
    key = (hashlib.sha256(content).digest(), build.__qualname__, *more)
    if key not in _built:
        _built.clear()
        _built[key] = build(content, *more)
    return _built[key]
