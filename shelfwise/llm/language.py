"""Language identification by rank-order profiles.

Method: the profile of a language is its most frequent n-grams of one to three letters, in order
of frequency. A document's own most frequent n-grams are compared with every profile by their
out-of-place distance; an n-gram missing in a profile costs the profile's length. The nearest
language wins. Words are lower-cased runs of letters, padded with a blank on both sides.

Three code points of 21 bits each fit in one 64-bit number, so n-grams are numbers without
collisions, and a text's n-grams are counted by sorting an array.

Defined results: null text and text without a letter give `und` and score 0, as does every text
where nothing could be learned; equal counts are ordered by n-gram, equal distances by language
name; score is 1 - distance / largest possible distance; rows without doc_id are not learned
from (held_out true); repeated rows are predicted alike; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import fold, rows_to_batch
from shelfwise.session import materialise

PROFILE = 400
UNKNOWN = "und"
# Stands for what is between words; not 0, so that longer n-grams are larger numbers.
PAD = 1
# A mistake in the data should not make a profile of each row: more languages are refused.
MOST_LANGUAGES = 2_000

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter; built once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as sorted numbers, and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letter_table()[codes], codes, PAD)
    codes = np.concatenate(([PAD], codes, [PAD])).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != PAD) | (codes[:-1] != PAD)
    codes = codes[keep]
    if len(codes) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pairs = codes[:-1] << np.uint64(21) | codes[1:]
    triples = codes[:-2] << np.uint64(42) | pairs[1:]
    return np.unique(
        np.concatenate((codes[codes != PAD], pairs, triples[codes[1:-1] != PAD])), return_counts=True)


def top(numbers: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent numbers in order; `numbers` ascend, which orders equal counts."""
    if len(counts) > 4 * size:  # all that can be among the first `size`, ties included
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        numbers, counts = numbers[counts >= least], counts[counts >= least]
    return numbers[np.argsort(-counts, kind="stable")[:size]]


GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> partial counts; held per language and given up batch by batch of texts."""
    for batch in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            numbers, counts = grams("\n".join(texts))
            if len(numbers):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(numbers)), pa.array(numbers.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    schema=GRAMS)


class Profiles:
    """All n-grams of all profiles in one sorted array, with their place in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size, self.langs = size, sorted({r[0] for r in rows})
        self.numbers = np.unique(np.array([r[1] for r in rows], np.uint64))
        self.places = np.full((len(self.numbers), len(self.langs)), -1, np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.numbers, np.uint64(gram)), column[lang]] = place

    def accepts(self, text: str | None, least_score: float, limits: dict[tuple[str | None, int], float] | None = None) -> bool:
        """Whether the text is in one of the languages; with none learned, whether it has a letter.

        limits: least score by language and length class, and by class alone, where they are known."""
        if not self.langs:
            return bool(text) and len(grams(text)[0]) > 0
        lang, score, size = self.judge(text)
        limits = limits or {}
        return lang != UNKNOWN and score >= max(least_score, limits.get((lang, size), limits.get((None, size), least_score)))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, int]:
        """Language, score and length class of a text."""
        if not text or not self.langs:
            return UNKNOWN, 0.0, 0
        own = top(*grams(text), self.size)
        if not len(own):
            return UNKNOWN, 0.0, 0
        at = np.minimum(np.searchsorted(self.numbers, own), len(self.numbers) - 1)
        known = self.numbers[at] == own
        places = self.places[at[known]]
        moved = np.minimum(np.abs(places - np.flatnonzero(known)[:, None]), self.size)
        distance = np.where(places < 0, self.size, moved).sum(0) + self.size * int((~known).sum())
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(own))), length_class(len(own))


def length_class(grams_of_text: int) -> int:
    """Texts of about the same number of different n-grams, the profile's length at most."""
    return grams_of_text.bit_length()


def learn(docs: DataFrame, size: int = PROFILE, most_languages: int = MOST_LANGUAGES) -> Profiles:
    """docs(lang, text) -> profiles, counted over all rows whose lang and text are not null.

    The driver gets `size` n-grams of each of at most `most_languages` languages.
    """
    counts = materialise(
        docs.where("lang is not null and text is not null").select("lang", "text")
        .mapInArrow(count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    if counts.select("lang").distinct().limit(most_languages + 1).count() > most_languages:
        raise ValueError(f"more than {most_languages} languages to learn")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= size)
    return Profiles([(r["lang"], r["gram"], r["place"] - 1) for r in best.select("lang", "gram", "place").collect()], size)


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, parts: int = 5, size: int = PROFILE) -> DataFrame:
    """documents -> doc_id, held_out, lang_pred, score; fold 0 of `parts` is not learned from."""
    held = F.coalesce(fold("doc_id", parts) == 0, F.lit(True))
    model = learn(docs.where(~held), size)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in batches:
            ids, held_out, texts = (batch.column(i).to_pylist() for i in range(3))
            yield rows_to_batch([(i, h, *profiles.predict(t)) for i, h, t in zip(ids, held_out, texts)], OUT)

    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


# A text whose n-grams lie this far from every profile is in none of the languages.
LEAST_SCORE = 0.1
# Limits lie so far below the score that all but a few in a thousand of the labelled texts reach.
MARGIN, ODD = 0.15, 0.002
# Fewer scores than these set no limit of a length class; a language with fewer has the limit of all.
LEAST_SCORES = 100
# Labelled texts are judged whole and by their first words, so that short texts have limits too.
FIRST_WORDS = (1, 2, 4, 8, 16, 32, 64, 128, 256)
SCORES = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("score", pa.float64())])


def starts_of(text: str) -> list[str]:
    """A text's first words, in all lengths it has, and the text."""
    words = text.split(maxsplit=FIRST_WORDS[-1])
    return [" ".join(words[:n]) for n in FIRST_WORDS if n < len(words)] + [text]


def learn_limits(docs: DataFrame, model: Profiles, shared) -> dict[tuple[str | None, int], float]:
    """docs(lang, text), not learned from -> least score by language and length class; None stands
    for all languages together.

    From the scores of the labelled texts that are judged as labelled. The driver gets a histogram:
    100 steps of the score for each language and class at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in starts_of(text):
                    said, score, size = profiles.judge(part)
                    if said == lang:
                        rows.append((lang, size, math.floor(score * 100) / 100))
            yield rows_to_batch(rows, SCORES)

    if not model.langs:
        return {}
    counts = (
        docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, size int, score double")
        .groupBy("lang", "size", "score").count().collect())
    by: dict[tuple[str | None, int], list[tuple[float, int]]] = {}
    for r in counts:
        for lang in (r["lang"], None):
            by.setdefault((lang, r["size"]), []).append((r["score"], r["count"]))
    limits = {}
    for key, scores in by.items():
        total, below = sum(n for _, n in scores), 0
        for score, n in sorted(scores):
            below += n
            if total >= LEAST_SCORES and below > ODD * total:
                limits[key] = score - MARGIN
                break
    return limits


def keep_identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs, whole, whose text is in one of the learned languages.

    Rejected: null text, text without letters, text with a score below the limit of its language
    and length, which comes from the labelled texts of the fold not learned from (of all languages
    where those of one are few), or below `least_score` where all are too few. Where no language could be learned, every text with a
    letter stays.
    """
    held = fold("doc_id", 5) == 0
    model = learn(docs.where(F.coalesce(~held, F.lit(False))))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limits = learn_limits(docs.where(F.coalesce(held, F.lit(False))), model, shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in batches:
            yield batch.filter(pa.array([profiles.accepts(t, least_score, limits) for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
