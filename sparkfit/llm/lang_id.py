"""Language identification by rank-order profiles.

A profile is the list of the most frequent n-grams (1 to 3 characters, words
padded by a blank on both sides) of all learning texts of a language, most
frequent first. A document's most frequent n-grams are compared to each profile
by the out-of-place distance: the sum over the document's n-grams of how far
apart the two ranks are, an n-gram the profile lacks counting as the profile's
length. The nearest language wins.

Counting runs on Arrow batches inside tasks, all n-grams of a run of texts in
one sorted array; Spark sums the counts by language and n-gram and keeps the
top of each language. Profiles are languages x ``PROFILE`` rows, a checked
bound (at most 300,000 entries, some 10 MB), and go to the tasks with the
function. Texts of any length are counted whole.

Results for special inputs: a text that is null or has no letter is ``und``
with score 0, and so is every text if nothing was learned; equal distances go
to the language that sorts first; n-grams of equal count are ranked by their
characters; a null id is neither learned from nor held out; repeated rows each
get their row; an empty table gives an empty result; columns other than id,
text and language are ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfit.llm.common import check_bound, ship, slices_by_bytes

PROFILE = 300               # n-grams of a profile, and of a document
MAX_LANGUAGES = 1000
UNKNOWN = "und"
LEAST_SCORE = 0.2           # of a text in a learned language, by keep_known_languages
MARGIN = 0.3                # by which another language must beat a text's label: what a text wholly
                            # in that language has, and one that only quotes it has not
LEAST_LETTERS = 200         # of a text that may go by its score
SLICE_BYTES = 1 << 19
CELLS = 1 << 22             # texts x languages compared at once
HELD_IN_TASK = 1 << 20      # summed n-grams that a counting task holds at once

ABSENT = (1 << 21) - 1      # stands where an n-gram is shorter than three
_tables: list[np.ndarray] = []


def _fold() -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased code point of each letter and mark, 0 for the rest; is letter)."""
    if not _tables:
        fold = np.zeros(0x110000, dtype=np.int64)
        letter = np.zeros(0x110000, dtype=bool)
        for point in range(0x110000):
            ch = chr(point)
            if ch.isalpha():
                letter[point] = True
                fold[point] = ord(ch.lower()[0])
            elif unicodedata.category(ch)[0] == "M":
                fold[point] = point
        _tables.extend((fold, letter))
    return _tables[0], _tables[1]


def count_ngrams(texts: list[str], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of all n-grams by owner (``owner[i]``: whose text i is, from 0).

    Returns (owner, n-gram, count) sorted by owner and n-gram, and per text the
    number of its letters. An n-gram is three code points of 21 bits: blanks
    are 0, missing ones ABSENT.
    """
    fold, letter = _fold()
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    letters = np.add.reduceat(letter[points].astype(np.int64), np.concatenate([[0], ends[:-1]]))
    f = fold[points]
    keep = f > 0
    keep[1:] |= f[:-1] > 0                          # of a run of others the first stays, as a blank
    at = np.flatnonzero(keep)
    # A blank in front, so that the first word has one too.
    f = np.concatenate([[0], f[at]])
    who = np.concatenate([[0], owner[np.searchsorted(ends, at, side="right")]])
    used = np.flatnonzero(np.bincount(f, minlength=1))
    if used[0] != 0:
        used = np.concatenate([[0], used])
    points_of = np.concatenate([used, [ABSENT]]).astype(np.int64)
    code = np.zeros(int(used[-1]) + 1, dtype=np.int64)
    code[used] = np.arange(len(used))
    c, none = code[f], np.int64(len(used))
    bits = np.int64(int(none).bit_length())
    if int(owner.max(initial=0)).bit_length() + 3 * int(bits) > 62:
        raise ValueError("too many owners for one call")
    x, y, z = c[:-2], c[1:-1], c[2:]
    one = c > 0
    two = (c[:-1] > 0) | (c[1:] > 0)
    three = y > 0
    blank2 = none << 2 * bits | none << bits
    keys = np.concatenate([
        (who << 3 * bits | blank2 | c)[one],
        (np.where(c[:-1] > 0, who[:-1], who[1:]) << 3 * bits | none << 2 * bits | c[:-1] << bits | c[1:])[two],
        (who[1:-1] << 3 * bits | x << 2 * bits | y << bits | z)[three]])
    if not len(keys):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, letters
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    mask = (np.int64(1) << bits) - 1
    gram = points_of[keys >> 2 * bits & mask] << 42 | points_of[keys >> bits & mask] << 21 | points_of[keys & mask]
    return keys >> 3 * bits, gram, counts, letters


def top_ranked(owner: np.ndarray, gram: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram, rank from 0) of each owner's ``k`` most frequent n-grams."""
    order = np.lexsort((gram, -counts, owner))
    owner = owner[order]
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    rank = np.arange(len(owner)) - start
    kept = rank < k
    return owner[kept], gram[order][kept], rank[kept]


@dataclass
class Profiles:
    """Languages in order, and the places of every profile n-gram: entries
    (language, rank) sorted by n-gram, those of n-gram i from ``first[i]`` on. At
    most ``MAX_LANGUAGES`` x ``size`` entries."""

    languages: list[str]
    grams: np.ndarray       # sorted
    first: np.ndarray
    of_language: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, rows: Iterable[tuple[str, int, int]], size: int) -> Profiles:
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        languages = sorted({r[0] for r in rows})
        column = {lang: i for i, lang in enumerate(languages)}
        grams, first = np.unique(np.array([r[1] for r in rows], dtype=np.int64), return_index=True)
        return cls(languages, grams, np.concatenate([first, [len(rows)]]).astype(np.int64),
                   np.array([column[r[0]] for r in rows], dtype=np.int64),
                   np.array([r[2] for r in rows], dtype=np.int64), size)

    def likeness(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text x language, which texts have one, letters of each text): 1 less
        the distance as a part of the largest distance the text's n-grams could
        have."""
        most = max(1, CELLS // max(1, len(self.languages)))
        if len(texts) > most:
            parts = [self.likeness(texts[a:a + most]) for a in range(0, len(texts), most)]
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        owner, gram, counts, letters = count_ngrams(texts, np.arange(len(texts)))
        near = np.zeros((len(texts), len(self.languages)))
        if not self.languages or not len(owner):
            return near, np.zeros(len(texts), dtype=bool), letters
        owner, gram, rank = top_ranked(owner, gram, counts, self.size)
        n = np.bincount(owner, minlength=len(texts))
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        at, owner, rank = at[known], owner[known], rank[known]
        # Every entry of a known n-gram brings its language nearer than a lacking one.
        many = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        gain = self.size - np.abs(self.ranks[entry] - np.repeat(rank, many))
        cell = np.repeat(owner, many) * len(self.languages) + self.of_language[entry]
        near += np.bincount(cell, weights=gain, minlength=near.size).reshape(near.shape)
        near /= np.maximum(n, 1)[:, None] * self.size
        return near, (n > 0) & (letters > 0), letters

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """(language, score) of each text, the score being its likeness."""
        near, known, _ = self.likeness(texts)
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i in np.flatnonzero(known).tolist():
            best = int(near[i].argmax())
            lang[i], score[i] = self.languages[best], float(near[i, best])
        return lang, score

    def judge(self, texts: list[str], labels: list[str | None]) -> tuple[list[str], list[float], list[float | None], list[int]]:
        """(language, score, score of the label's language, letters) of each text."""
        near, known, letters = self.likeness(texts)
        column = {lang: i for i, lang in enumerate(self.languages)}
        best = near.argmax(axis=1) if self.languages else None
        lang = [self.languages[best[i]] if k else UNKNOWN for i, k in enumerate(known.tolist())]
        score = [float(near[i, best[i]]) if k else 0.0 for i, k in enumerate(known.tolist())]
        own = [float(near[i, column[x]]) if x in column else None for i, x in enumerate(labels)]
        return lang, score, own, letters.tolist()


def is_held_out(id_col: str = "doc_id") -> Column:
    """Remainder 2 of the crc32 of the id as text, by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ngram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs in all texts of a language."""
    ship(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        index: dict[str, int] = {}
        held: list[tuple] = []

        def summed() -> tuple:
            who, gram, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((gram, who))
            who, gram, n = who[order], gram[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])]))
            return who[first], gram[first], np.add.reduceat(n, first)

        def emit() -> Iterator[pa.RecordBatch]:
            who, gram, n = held[0]
            for a in range(0, len(who), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names).take(pa.array(who[part])), pa.array(gram[part]), pa.array(n[part])],
                    names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in slices_by_bytes(batch, "t", SLICE_BYTES):
                langs = part.column(0).to_pylist()
                for lang in langs:
                    if lang not in index:
                        index[lang] = len(names)
                        names.append(lang)
                owner = np.fromiter((index[x] for x in langs), dtype=np.int64, count=len(langs))
                who, gram, n, _ = count_ngrams(part.column(1).to_pylist(), owner)
                if len(who):
                    held.append((who, gram, n))
                    if len(held) > 8:
                        held[:] = [summed()]
                if held and len(held[0][0]) > HELD_IN_TASK:
                    held[:] = [summed()]
                    yield from emit()
        if held:
            held[:] = [summed()]
            yield from emit()

    rows = docs.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    part = rows.where("l IS NOT NULL AND t IS NOT NULL").mapInArrow(run, "lang string, gram bigint, n bigint")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> Profiles:
    """Profiles learned from every row that has a text and a language."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    # Compared with the row number itself, which lets each task keep only its own
    # ``size`` first rows of a language before they meet.
    top = ngram_counts(docs, lang_col, text_col).withColumn("place", F.row_number().over(order)) \
        .where(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("rank"))
    rows = top.limit(MAX_LANGUAGES * size + 1).collect()
    check_bound("rows of all language profiles", len(rows), MAX_LANGUAGES * size)
    return Profiles.of(((r["lang"], r["gram"], r["rank"]) for r in rows), size)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
                      keep: list[str] | None = None) -> DataFrame:
    """(id, lang_pred, score) of every row, and ``keep``: further columns to
    carry along. Only the text is an input of the prediction."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(profiles)
    carried = [id_col, *(keep or [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t", SLICE_BYTES):
                lang, score = shared.value.predict([t or "" for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(lang, type=pa.string()), pa.array(score, type=pa.float64())],
                    names=[*names, "p", "s"])

    # Columns travel by place, so their names cannot clash.
    rows = docs.select(F.col(text_col).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])
    names = [f"c{i}" for i in range(len(carried))]
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"{n} {types[c]}" for n, c in zip(names, carried, strict=True)), "p string", "s double"])
    return rows.mapInArrow(run, schema).toDF(*carried, "lang_pred", "score")


def keep_known_languages(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str | None = "lang",
                         languages: tuple[str, ...] | None = None, least_score: float = LEAST_SCORE,
                         margin: float = MARGIN, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """The rows whose text is in a known language, with the columns of ``docs``.

    A row goes if its text is null or has no letter; if ``languages`` are named
    and its predicted one is none of them; and, where the text has
    ``least_letters`` letters or more, which is what a ranking needs, if its
    score is below ``least_score`` (a language that was not learned) or if its
    label in ``lang_col`` is another language whose score is lower by more than
    ``margin`` (a wrong label). A null or unlearned label, and ``lang_col``
    None, contradict nothing. Nothing goes if nothing was learned."""
    if not profiles.languages:
        return docs
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(profiles)
    # Columns travel by place, so their names cannot clash, and the text once.
    names = [f"c{i}" for i in range(len(docs.columns))]
    places = {c.lower(): i for i, c in enumerate(docs.columns)}
    text_at, lang_at = places[text_col.lower()], None if lang_col is None else places[lang_col.lower()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, names[text_at], SLICE_BYTES):
                labels = [None] * part.num_rows if lang_at is None else part.column(lang_at).cast(pa.string()).to_pylist()
                lang, score, own, letters = shared.value.judge([t or "" for t in part.column(text_at).to_pylist()], labels)
                stays = np.ones(part.num_rows, dtype=bool)
                for i in range(part.num_rows):
                    if lang[i] == UNKNOWN or (languages is not None and lang[i] not in languages):
                        stays[i] = False
                    elif letters[i] >= least_letters:
                        wrong = own[i] is not None and lang[i] != labels[i] and score[i] - own[i] > margin
                        stays[i] = score[i] >= least_score and not wrong
                yield part.filter(pa.array(stays))

    schema = ", ".join(f"{n} {t}" for n, (_, t) in zip(names, docs.dtypes, strict=True))
    return docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns)
