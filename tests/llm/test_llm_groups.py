"""Near dedup, components, mixing, chat rotation and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_cases import ROWS, edge_documents, no_documents, texts_of
from pyspark.sql import functions as F

import corpus_pipeline
from sparkfit.llm import chat, mixture, near_dedup, queries
from sparkfit.llm.components import connected_components
from sparkfit.llm.words import shingle_sets, word_hashes

UPPER_TO_LOWER = {ord(a): ord(a) + 32 for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SPACES = " \t\n\x0b\x0c\r"


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)


def plain_words(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.translate(UPPER_TO_LOWER).split(" ") if w]


def plain_set(text, k):
    w = plain_words(text or "")
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def plain_groups(rows, k, percent=80):
    """Row number -> root row number, by comparing all pairs."""
    sets = [plain_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= percent * (len(x) + len(y) - n):
                    up[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(a) for a in range(len(rows))]


def plain_near(rows, k, percent=80):
    """(id, n_shingles, component_id, kept) by comparing all pairs."""
    sets, root = plain_groups(rows, k, percent)
    names = {}
    for r, (i, _) in zip(root, rows, strict=True):
        names[r] = min([x for x in (names.get(r), i) if x is not None], default=None)
    return [(i, len(s), names[r], i == names[r]) for (i, _), s, r in zip(rows, sets, root, strict=True)]


def variants(seed, base, copies, most):
    """``base`` with up to ``most`` of its words replaced, in ``copies`` texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def planted(seed=1):
    rng = random.Random(seed)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 150]))]
        texts += variants(seed + g, base, 25, max(1, len(base) // 25))
    texts += [" ".join(f"u{rng.randrange(5000)}" for _ in range(80)) for _ in range(60)]
    shared = " ".join(f"passage{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"s{rng.randrange(5000)}" for _ in range(70)) for _ in range(40)]
    texts += ["a b", "A  b", "a b c d", "a b c", "", None, " "]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_all_pairs(spark, k):
    rows = planted(k)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = near_dedup.near_duplicates(docs, shingle=k).drop("text_hash")
    assert by_repr(found.collect()) == by_repr(plain_near(rows, k))


def test_near_blocks_equal_all_pairs(spark, monkeypatch):
    # Buckets and clusters cut into several blocks each.
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 6)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    rows = planted(9)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = near_dedup.near_duplicates(docs, shingle=4).drop("text_hash")
    assert by_repr(found.collect()) == by_repr(plain_near(rows, 4))


def test_groups_join_and_tell_who_is_apart():
    groups = near_dedup.Groups(6)
    groups.join(np.array([4, 2, 5]))
    groups.join(np.array([1, 3]))
    assert groups.of.tolist() == [0, 1, 2, 1, 2, 2]
    assert groups.apart(4, np.array([0, 2, 3, 5])).tolist() == [0, 3]
    groups.join(np.array([5, 3]))
    assert groups.of.tolist() == [0, 1, 1, 1, 1, 1]


def test_near_edge_cases(spark):
    rows = [(i, t) for i, t, *_ in ROWS]
    found = near_dedup.near_duplicates(edge_documents(spark), shingle=4).drop("text_hash")
    assert by_repr(found.collect()) == by_repr(plain_near(rows, 4))
    left = near_dedup.drop_near_duplicates(edge_documents(spark), shingle=4)
    _, root = plain_groups(rows, 4)
    assert left.columns == edge_documents(spark).columns
    assert left.count() == len(set(root))
    assert near_dedup.near_duplicates(no_documents(spark)).collect() == []
    assert near_dedup.drop_near_duplicates(no_documents(spark)).collect() == []


def test_sequential_test_misses_as_little_as_chosen():
    test = near_dedup.Sequential(0.8, near_dedup.MISS)
    rng = np.random.default_rng(0)
    one = np.zeros(near_dedup.HASHES, dtype=np.uint16)
    at = (rng.random((200_000, near_dedup.HASHES)) >= 0.8).astype(np.uint16)
    assert 200_000 - len(test.survivors(one, at)) <= 5
    apart = (rng.random((20_000, near_dedup.HASHES)) >= 0.3).astype(np.uint16)
    assert len(test.survivors(one, apart)) == 0


def test_word_and_shingle_counts():
    texts = [t or "" for _, t, *_ in ROWS] + ["one", "a b c d e", "x\x0by\x0cz\r\nW"]
    hashes, first = word_hashes([t.encode() for t in texts])
    seen = {}
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        words = plain_words(text)
        assert b - a == len(words)
        for w, h in zip(words, hashes[a:b].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    for k in (1, 4, 5):
        assert [len(s) for s in shingle_sets([t.encode() for t in texts], k)] == [len(plain_set(t, k)) for t in texts]


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(f"a{i:03}", f"a{i + 1:03}") for i in range(60)] + [("hub", f"leaf{i}") for i in range(50)]
    edges += [("x", "y"), ("y", "z"), ("z", "x"), ("x", "x"), ("alone", "alone"), ("x", "y")]
    rng.shuffle(edges)
    found = {r["node"]: r["label"] for r in connected_components(
        spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert {v for k, v in found.items() if k[0] == "a"} == {"a000"}
    assert {v for k, v in found.items() if k[:3] in ("hub", "lea")} == {"hub"}
    assert [found[k] for k in "xyz"] == ["x"] * 3
    assert connected_components(spark.createDataFrame([], "src string, dst string")).collect() == []


# --- mixing

def plain_targets(sizes):
    """Shares by weight 5, 2, 1 of the sources in order, excess over three
    times a source's size handed on until none is above."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    fixed = {}
    while True:
        left = sum(sizes) - sum(fixed.values())
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed.update({i: 3 * sizes[i] for i in over})


def check_mix(rows, found):
    """rows (id, text, source); found rows of the mix query in any order."""
    size = [(i, len(plain_words(t or "")), s) for i, t, s in rows]
    sources = sorted({s for _, _, s in size}, key=lambda s: (s is None, s or ""))
    total = Counter()
    for _, n, s in size:
        total[s] += n
    target = dict(zip(sources, plain_targets([total[s] for s in sources]), strict=True))
    assert by_repr((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in found) == by_repr(
        (i, n, total[s], round(target[s], 6)) for i, n, s in size)
    by_target = Counter()
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[r["source_size"], round(r["target"], 6)] += r["taken"]
    want = Counter()
    for s in sources:
        want[total[s], round(target[s], 6)] += min(round(target[s]), 3 * total[s])
    assert {k: v for k, v in by_target.items() if v} == {k: v for k, v in want.items() if v}


def test_mix_query(spark):
    rows = [(i, t, s) for i, t, _, s in texts_of(SF_SMALL)]
    found = queries.op3_source_mix(spark, SF_SMALL).collect()
    check_mix(rows, found)
    again = queries.op3_source_mix(spark, SF_SMALL).collect()
    assert by_repr(found) == by_repr(again)


def test_mix_edge_cases(spark):
    docs = edge_documents(spark)
    cols = ["doc_id", "size", "source_size", "target", mixture.words_taken().alias("taken")]
    found = mixture.mix(docs, shards=3, blocks=4).select(*cols).collect()
    check_mix([(r[0], r[1], r[3]) for r in ROWS], found)
    other = mixture.mix(docs.repartition(7), shards=3, blocks=4).select(*cols).collect()
    assert by_repr(found) == by_repr(other)
    assert mixture.mix(no_documents(spark)).collect() == []
    assert mixture.mixed_documents(no_documents(spark)).collect() == []


def test_mix_draws_are_disjoint_and_shards_even(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), f"s{min(i % 7, 2)}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    draws = mixture.mix(docs, shards=8, blocks=32).select("doc_id", "size", F.explode("draws").alias("d")) \
        .select("doc_id", "size", "d.*").collect()
    assert len({(r["doc_id"], r["pass"]) for r in draws}) == len(draws)
    assert max(Counter(r["doc_id"] for r in draws).values()) <= 4
    words = Counter()
    for r in draws:
        assert 0 < r["words"] <= r["size"]
        words[r["shard"]] += r["words"]
    assert len(words) == 8 and max(words.values()) < 2.5 * min(words.values())


def test_quota_tree_splits_exactly():
    quotas = [1000, 3, 0, 77, 5000]
    out = mixture.split_quotas(quotas, 13, 7)
    assert out.sum(axis=0).tolist() == quotas and (out >= 0).all()
    totals = out.sum(axis=1)
    assert totals.max() - totals.min() <= 4
    assert (out == mixture.split_quotas(quotas, 13, 7)).all()
    # A shard's share of a source has the hypergeometric mean and spread.
    first = np.array([mixture.split_quotas([400, 1600], 4, seed)[0, 0] for seed in range(400)])
    assert abs(first.mean() - 100) < 2 and abs(first.var() / (500 * .2 * .8 * 1500 / 1999) - 1) < 0.35


def test_mixed_documents_are_rows_of_the_input(spark):
    docs = edge_documents(spark)
    mixed = mixture.mixed_documents(docs, shards=3, blocks=4)
    assert mixed.columns == docs.columns
    rows = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    given = Counter((r[0], r[1]) for r in ROWS)
    assert all(k in given and n <= 4 * given[k] for k, n in rows.items())


# --- chat

def plain_rotation(rows):
    out = []
    for conv in {r[0] for r in rows}:
        said = [(t, s or "unknown", x or "") for c, t, s, x in rows if c == conv]
        for who in {s for _, s, _ in said if s != "system"}:
            for t, s, x in said:
                role = "assistant" if s == who else "system" if s == "system" else "user"
                head = f"<|im_start|>{role}" + (f" name={s}" if role == "user" else "") + "\n"
                text = head + x + "<|im_end|>\n"
                out.append((conv, who, t, s, role, text, len(head), len(text) if s == who else len(head)))
    return out


CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "héllo"), (1, 2, "bob", "hi"), (1, 3, "cy", None), (1, 4, "ann", ""),
    (2, 0, "system", "alone"), (3, 0, None, "who am I"), (3, 1, "bob", "x"), (4, None, "ann", "no turn"),
    (4, 1, "bob", "y"), (None, 0, "ann", "no conv"), (5, 0, "ann", "twice"), (5, 0, "ann", "twice"), (5, 70, "bob", "far")]


def test_rotation(spark):
    rows = CONVERSATIONS
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, conv string, speaker string, said string")
    found = chat.rotate(frame)
    assert by_repr(found.collect()) == by_repr(plain_rotation(rows))
    assert chat.rotate(frame.limit(0)).collect() == []


def test_assembled_dialogues_and_masks(spark):
    frame = spark.createDataFrame(CONVERSATIONS, "conv_id bigint, turn bigint, role string, text string")
    parts = {(r["conv_id"], r["perspective"], r["part"]): r for r in chat.assemble(chat.rotate(frame), window=64).collect()}
    bob = parts[1, "bob", 0]
    assert bob["dialogue"] == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhéllo<|im_end|>\n"
                               "<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=cy\n<|im_end|>\n"
                               "<|im_start|>user name=ann\n<|im_end|>\n")
    assert [bob["dialogue"][m["start"]:m["end"]] for m in bob["masks"]] == ["hi<|im_end|>\n"]
    ann = parts[1, "ann", 0]
    assert [ann["dialogue"][m["start"]:m["end"]] for m in ann["masks"]] == ["héllo<|im_end|>\n", "<|im_end|>\n"]
    assert (5, "bob", 1) in parts and parts[5, "ann", 0]["dialogue"].count("twice") == 2


@pytest.mark.parametrize("window", [2, 64])
def test_dialogues_are_all_messages_in_order_and_bounded_parts(spark, window):
    rows = CONVERSATIONS + [(6, 5, who, f"m{i}") for i in range(150) for who in ("ann", "bob")]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, conv string, row_no int")
    found = chat.dialogues(frame.repartition(5), window=window).collect()
    want = {}
    for conv in {r[0] for r in rows}:
        said = [(t is not None, t or 0, s or "unknown", hashlib.md5((x or "").encode()).hexdigest(), x or "")
                for c, t, s, x in rows if c == conv]
        for who in {s for _, _, s, _, _ in said if s != "system"}:
            for i, (_, _, s, _, x) in enumerate(sorted(said)):
                role = "assistant" if s == who else s if s == "system" else f"user name={s}"
                want.setdefault((conv, who, i // window), []).append((f"<|im_start|>{role}\n", f"{x}<|im_end|>\n", s == who))
    assert len(found) == len(want)
    for r in found:
        turns = want[r["conv_id"], r["perspective"], r["part"]]
        assert r["n_turns"] == len(turns) <= window
        assert r["dialogue"] == "".join(h + b for h, b, _ in turns)
        assert [r["dialogue"][m["start"]:m["end"]] for m in r["masks"]] == [b for _, b, own in turns if own]
    assert chat.dialogues(frame.limit(0)).collect() == []


# --- pipeline

def test_pipeline_stages_on_awkward_rows(spark):
    docs = edge_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
        assert stage(spark, no_documents(spark), "").collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, no_documents(spark), "").collect() == []


def test_pipeline_against_plain_stages(spark):
    import base64

    import public_tokenizers
    import tiktoken
    rows = texts_of(SF_SMALL)
    # 1. Documents without a letter go.
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    # 2. The largest id of equal texts stays.
    last = {}
    for r in sorted(rows):
        last[r[1].translate(UPPER_TO_LOWER)] = r
    rows = sorted(last.values())
    # 3. The smallest id of each group of near copies stays.
    kept = {i for i, _, _, k in plain_near([(r[0], r[1]) for r in rows], 5) if k}
    rows = [r for r in rows if r[0] in kept]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == [r[0] for r in rows]

    # 4. Sources near their targets, counted in whole documents.
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    by_id = {r[0]: r for r in rows}
    words = {i: len(plain_words(r[1])) for i, r in by_id.items()}
    sources = sorted({r[3] for r in rows})
    sizes = [sum(words[r[0]] for r in rows if r[3] == s) for s in sources]
    taken, times = Counter(), Counter()
    for r in found:
        taken[r["source"]] += words[r["doc_id"]]
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 4
    longest = {s: max(words[r[0]] for r in rows if r[3] == s) for s in sources}
    for s, target in zip(sources, plain_targets(sizes), strict=True):
        assert abs(taken[s] - target) <= longest[s] / 2 + 1, s

    # 5. Ids as the library gives them.
    ranks = {base64.b64decode(a): int(b) for a, b in map(
        bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in found:
        assert r["ids"] == own.encode_ordinary(by_id[r["doc_id"]][1])
