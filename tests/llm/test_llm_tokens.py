"""Token files, token counts and byte-level BPE against the libraries."""

import base64
import glob
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ROWS, edge_documents, no_documents, texts_of
from tokenizers import Tokenizer

from sparkfit.llm import byte_bpe, queries, token_counts, token_files, vocab
from sparkfit.llm.chunks import ChunkCache, ChunkedEncoder, in_batches
from sparkfit.session import scratch_path

GPT = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def gpt():
    return Tokenizer.from_file(GPT)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def multi():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec.parse(open(MULTI, "rb").read(), public_tokenizers.PATTERN)


def expected_files(rows, gpt):
    """Rows (doc_id, start, n_tokens, crc) in ascending id order."""
    out, start = [], 0
    for i, text in rows:
        ids = [*gpt.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, gpt):
    found = queries.op1_token_files(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    want = expected_files([r[:2] for r in sorted(texts_of(SF_SMALL))], gpt)
    assert sorted(map(tuple, found)) == want


def test_token_files_edge_cases(spark, gpt):
    path = scratch_path(spark, "edge-tokens")
    token_files.write_token_files(edge_documents(spark), path, GPT, 2)
    files = token_files.read_token_files(spark, path)
    found = token_files.document_checksums(files).collect()
    key = {r["start"]: (r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found}
    assert len(found) == len(ROWS)
    # Null ids first, then ascending; the starts follow without a gap.
    at, ids = 0, []
    for start in sorted(key):
        assert start == at
        ids.append(key[start][0])
        at += key[start][1]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = {(i, n, c) for i, _, n, c in expected_files([r[:2] for r in ROWS], gpt)}
    assert {v for v in key.values()} == want
    meta = sorted(map(tuple, token_files.token_metadata(files).collect()), key=lambda r: r[1])
    assert [m[1] for m in meta] == sorted(key)


def test_token_files_empty(spark):
    path = scratch_path(spark, "no-tokens")
    token_files.write_token_files(no_documents(spark), path, GPT, 2)
    files = token_files.read_token_files(spark, path)
    assert token_files.document_checksums(files).collect() == []
    assert token_files.token_metadata(files).collect() == []


def test_token_file_layout(spark):
    path = scratch_path(spark, "layout")
    token_files.write_token_files(edge_documents(spark), path, GPT, 2)
    names = glob.glob(path.removeprefix("file://") + "/*.parquet")
    rows = 0
    for name in names:
        meta = pq.ParquetFile(name).metadata
        rows += meta.num_rows
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c)
                       for c in range(meta.num_columns)}
            ids = columns["ids.list.element"]
            assert "RLE_DICTIONARY" in ids.encodings and ids.compression == "ZSTD"
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            assert "DELTA_BINARY_PACKED" in columns["start"].encodings
            assert all(c.has_offset_index and c.has_column_index for c in (columns["doc_id"], columns["n_tokens"]))
    assert rows == len(ROWS)


def test_selective_reads(spark):
    path = scratch_path(spark, "selective")
    token_files.write_token_files(edge_documents(spark), path, GPT, 2)
    files = token_files.read_token_files(spark, path)
    plan = token_files.token_metadata(files)._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("== Physical Plan ==")[1]
    plan = files.where("doc_id BETWEEN 5 AND 7")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan


def test_token_counts_query(spark, words):
    found = sorted(map(tuple, queries.op6_token_counts(spark, SF_SMALL)
                       .select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()))
    want = []
    for i, text, _, _ in sorted(texts_of(SF_SMALL)):
        n = len(words.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    assert found == want


def test_token_counts_edge_cases(spark, words):
    found = token_counts.count_tokens(edge_documents(spark), WORDS, 2048)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for i, text, *_ in ROWS:
        n = len(words.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    key = lambda r: repr(r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(no_documents(spark), WORDS, 2048).collect() == []


def test_token_counts_of_a_model_file(spark):
    from sentencepiece import SentencePieceProcessor
    path = public_tokenizers.path("piece_bpe_32k.model")
    own = SentencePieceProcessor(model_file=path)
    found = token_counts.count_tokens(edge_documents(spark), path, 10).select("doc_id", "n_tokens").collect()
    want = [(i, len(own.encode(t or ""))) for i, t, *_ in ROWS]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


AWKWARD = st.text(alphabet=st.one_of(
    st.sampled_from(list("abcdeéèßñ'  \n\t\r\x1c\x85\xa0 　.,!?0129٣ΣİǅK中文한🎉👍🏽̧́|<>")),
    st.characters(exclude_categories=("Cs",))), max_size=60)
SPLICED = st.lists(st.one_of(AWKWARD, st.sampled_from([" the", "  ", "\n\n", " don't", "<|endoftext|>", "<|startoftext|>",
                                                                " word,", " it's.", " É,", " a, b. c"])),
                   max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(SPLICED, min_size=1, max_size=5))
def test_chunked_ids_are_the_library_s(gpt, words, texts):
    own = vocab.LibraryTokenizer(open(GPT, "rb").read())
    for encode in (ChunkedEncoder(own.ids), ChunkedEncoder(own.ids, own.word_ids)):
        ids, counts = encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
            e.ids for e in gpt.encode_batch(texts, add_special_tokens=False)]
    count = token_counts.json_counter(open(WORDS, "rb").read()) if not hasattr(test_chunked_ids_are_the_library_s, "c") \
        else test_chunked_ids_are_the_library_s.c
    test_chunked_ids_are_the_library_s.c = count
    assert count(pa.array(texts)).tolist() == [len(e.ids) for e in words.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(SPLICED, min_size=1, max_size=5))
def test_byte_bpe_is_tiktoken_s(codec, multi, texts):
    found = codec.encode(pa.array(texts))
    assert [x.tolist() for x in found] == [multi.encode_ordinary(t) for t in texts]
    assert [codec.decode(x).decode() for x in found] == texts


@settings(max_examples=100, deadline=None)
@given(pieces=st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=20))
def test_trees_in_step_merge_like_a_single_one(codec, pieces):
    found = byte_bpe.merge_pieces(pieces, codec.ranks)
    for piece, ids in zip(pieces, found, strict=True):
        whole = codec.ranks.ranks.get(piece)
        want = [whole] if whole is not None else byte_bpe.merge_piece(piece, codec.ranks)
        assert np.frombuffer(ids, dtype="<u4").tolist() == want


def test_single_byte_vocabulary_is_checked():
    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.Ranks({b"a": 0}, public_tokenizers.PATTERN)


def test_byte_bpe_query(spark, multi):
    found = sorted(map(tuple, queries.op10_byte_bpe(spark, SF_SMALL)
                       .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    want = []
    for i, text, _, _ in sorted(texts_of(SF_SMALL)):
        ids = multi.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == want


def test_byte_bpe_edge_cases(spark, multi):
    found = byte_bpe.encode_documents(edge_documents(spark), MULTI, public_tokenizers.PATTERN, keep=["c0", "Score"])
    assert found.columns == ["doc_id", "c0", "Score", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    rows = found.collect()
    want = [(i, multi.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS]
    assert sorted(((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in rows), key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode_digests(no_documents(spark), MULTI, public_tokenizers.PATTERN).collect() == []


def test_unknown_tokenizers_are_not_cut():
    spec = json.load(open(GPT))
    assert vocab.safe_cut(spec) is not None
    assert vocab.safe_cut({**spec, "normalizer": {"type": "NFKC"}}) is None
    assert vocab.safe_cut({**spec, "added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]}) is None
    assert vocab.safe_cut({**spec, "pre_tokenizer": {"type": "Whitespace"}}) is None
    assert vocab.safe_cut(json.load(open(WORDS))) is not None


def test_chunk_cache_is_bounded():
    calls = []
    cache = ChunkCache(lambda cs: calls.append(len(cs)) or [c.upper() for c in cs], limit=10, endings={",": ","})
    for a in range(0, 200, 5):
        chunks = {f"c{i}" for i in range(a, a + 8)} | {"often", "often,", "x" * 500, "", ",", "1,"}
        known = cache.resolve(chunks)
        assert all(known[c] == c.upper() for c in chunks)
        assert len(cache.young) + len(cache.old) <= 2 * (10 + 10) + 2
    assert in_batches(["a" * 10] * 7, lambda b: [len(b)] * len(b), target=25) == [2, 2, 2, 2, 2, 2, 1]
