"""Document fingerprints from closed syncmers.

Method: of all k-mers (12 code points) of a text those are chosen whose smallest inner s-mer
(4 code points, by hash) lies at either edge. Whether a k-mer is chosen depends on itself alone,
so the same passage gives the same anchors wherever it stands. A fingerprint holds all anchors in
the order of the text, each with its distance from the one before.

Two fingerprints are compared on all anchors: those in both count if they are in the longest chain
that has the same order in both texts. Likeness is 2 c / (m + c) for c such anchors of m in either:
the share of text in common.

Defined results: null is empty text; an empty text has the empty fingerprint, alike (1) only to
another empty one; a text too short or too uniform to have a chosen k-mer has one anchor, made of
the whole text; the n-th occurrence of an anchor is matched with the n-th in the other text. The documents are ordered by
doc_id descending, null last, rows with the same id by text hash; the last one's next is the
first, a single document's next is itself. Other columns are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import rows_to_batch
from shelfwise.llm.ranges import bounds, parts_for, range_of

K, S = 12, 4
BASE = 0x9E3779B97F4A7C15
# Of an anchor: 8 of the hash, 1 of the distance, as one of K - S + 1 consecutive k-mers is chosen.
DIGITS = 9
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def scramble(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray, left_length: int, right_length: int) -> np.ndarray:
    """Hashes of all runs of both lengths together from those of the shorter runs."""
    return left[:len(left) - right_length] * np.uint64(pow(BASE, right_length, 1 << 64)) + right[left_length:]


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    have = 1
    while 2 * have <= width:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the chosen k-mers and where they start, in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(codes) < K:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    one = scramble(codes + np.uint64(BASE))
    two = joined(one, one, 1, 1)
    four = joined(two, two, 2, 2)
    eight = joined(four, four, 4, 4)
    inner, outer = scramble(four), joined(eight, four, 8, 4)
    least = least_of(inner, K - S + 1)
    chosen = np.flatnonzero((inner[:len(least)] == least) | (inner[K - S:] == least))
    return (scramble(outer[chosen]) >> np.uint64(32)).astype(np.uint32), chosen


def anchors_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and distances of a text's anchors; one stands for a text without a chosen k-mer."""
    hashes, places = anchors(text)
    if text and not len(hashes):
        return np.array([zlib.crc32(text.encode("utf-8", "surrogatepass"))], np.uint32), np.zeros(1, np.int64)
    return hashes, np.diff(places, prepend=0)


def written(hashes: np.ndarray, distances: np.ndarray) -> str:
    digits = np.empty((len(hashes), DIGITS), np.uint8)
    for i in range(8):
        digits[:, i] = HEX[hashes >> np.uint32(28 - 4 * i) & np.uint32(15)]
    digits[:, 8] = HEX[distances]
    return digits.tobytes().decode()


def fingerprint(text: str) -> str:
    return written(*anchors_of(text))


def numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each anchor as a number of its hash and of how often it came before, ascending, and its rank
    in the text."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order].astype(np.uint64)
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.arange(len(ordered))
    return ordered << np.uint64(32) | (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64), order


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two texts by the hashes of their anchors, in text order."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    (one, rank_one), (two, rank_two) = numbered(a), numbered(b)
    _, in_one, in_two = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    place = rank_two[in_two][np.argsort(rank_one[in_one])]
    if (place[1:] > place[:-1]).all():
        length = len(place)
    else:
        chain: list[int] = []
        for x in place.tolist():
            at = bisect_left(chain, x)
            chain[at:at + 1] = [x]
        length = len(chain)
    return 2 * length / (len(a) + len(b) - len(place) + length)


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints."""
    read = lambda x: np.array([int(x[i:i + 8], 16) for i in range(0, len(x), DIGITS)], np.uint32)
    return alike(read(a), read(b))


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, context) in order; each but those of context is compared with the next."""
    held = None
    for batch in batches:
        rows = []
        for doc_id, text, context in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = text or ""
            own = anchors_of(text)
            if held:
                rows.append(judged(*held, text, own))
            held = None if context else (doc_id, text, own)
        yield rows_to_batch(rows, OUT)


def judged(doc_id, text: str, own: tuple, after: str, following: tuple) -> tuple:
    n = len(text)
    edited = text[:n - n // 2] + after[:n // 2]
    changed = anchors_of(edited)
    return (
        doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(*own), written(*changed),
        alike(own[0], changed[0]), alike(own[0], following[0]))


def compare(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are shuffled once, into ranges of ids; the first document of each range is also sent to
    the range before it, where it is the last one's next.
    """
    thin = docs.select(F.col("doc_id").cast("long"), "text")
    cuts = bounds(thin, "doc_id", parts_for(thin))
    keyed = thin.select(range_of("doc_id", cuts).alias("part"), "doc_id", F.xxhash64("text").alias("tie"), "text")
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")).alias("first")
    firsts = keyed.groupBy("part").agg(first).select("part", "first.doc_id", "first.tie").collect()  # one row per range
    filled = sorted((r["part"], r["doc_id"], r["tie"]) for r in firsts)
    sent = [(part, doc_id, tie, filled[(i + 1) % len(filled)][0]) for i, (part, doc_id, tie) in enumerate(filled)]
    heads = docs.sparkSession.createDataFrame(sent, "head_part int, head_id long, head_tie long, also int")
    at_head = (
        (F.col("part") == F.col("head_part")) & F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
    dealt = keyed.join(F.broadcast(heads), at_head, "left").select(
        F.explode(F.when(F.col("also").isNull(), F.array(F.struct("part", F.lit(False).alias("context"))))
                  .otherwise(F.array(F.struct("part", F.lit(False).alias("context")), F.struct(F.col("also").alias("part"), F.lit(True).alias("context")))))
        .alias("to"), "doc_id", "tie", "text")
    ordered = (
        dealt.select("to.part", "to.context", "doc_id", "tie", "text").repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("context", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()))
    return ordered.select("doc_id", "text", "context").mapInArrow(
        compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
