"""Best-fit packing of documents into sequences of a fixed number of tokens.

Method: hierarchical residual packing. Each task tokenizes its documents and packs their pieces
by best fit, largest first; nearly full bins are done, the others go up as items. Those are dealt
into groups of bounded size and packed again, group by group, until one group is left or packing
gains nothing more. Longer documents alone are cut, at multiples of the sequence length.

A bin carries its pieces as fixed-size records, so merging two bins joins their records, and no
join is needed to find the pieces in the end. Bins of a task are held in bounded numbers.

Defined results: null or empty text is the end id alone; repeated rows are packed each; equal
lengths are taken in the order they come; an empty table gives an empty result; null doc_id is
kept; other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import rows_to_batch
from shelfwise.llm.encoding import encoder
from shelfwise.session import materialise

LENGTH = 2048
# A bin with at most so many places left is done.
SPARE = 8
# Items packed together at most; bounds a task's memory and the last round.
HELD = 20_000
END = b"\0\0\0\0"
PIECE = struct.Struct("<?qiqiI")  # doc_id known, doc_id, piece, start, length, crc32 of the ids

BINS = pa.schema([("sequence_id", pa.int64()), ("fill", pa.int32()), ("pieces", pa.binary())])
BINS_DDL = "sequence_id long, fill int, pieces binary"


def pieces_of(doc_id: int | None, ids: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(length, record) of each piece of a document whose ids are given with the end id."""
    step = 4 * length
    for n, at in enumerate(range(0, len(ids), step)):
        part = ids[at:at + step]
        yield len(part) // 4, PIECE.pack(doc_id is not None, doc_id or 0, n, at // 4, len(part) // 4, zlib.crc32(part))


def best_fit(items: list[tuple[int, bytes]], length: int) -> list[tuple[int, bytes]]:
    """Best fit, largest first. Bins with the same room wait in one list; a number's bits say
    which rooms have any, so the smallest room that is large enough is found by a shift."""
    rooms: list[list[list[bytes]]] = [[] for _ in range(length + 1)]
    open_rooms = 0
    for size, record in sorted(items, key=lambda x: -x[0]):
        above = open_rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            held = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            room, held = length, []
        held.append(record)
        rooms[room - size].append(held)
        open_rooms |= 1 << (room - size)
    return [(length - room, b"".join(held)) for room, bins in enumerate(rooms) for held in bins]


def packed(items: Iterable[tuple[int, bytes]], length: int, spare: int, level: int) -> Iterator[pa.RecordBatch]:
    """Bins of a task; those that are done get a sequence id, unique by level, task and count."""
    first = level << 56 | TaskContext.get().partitionId() << 32
    done = 0

    def give_up(held):
        nonlocal done
        rows = []
        for fill, pieces in best_fit(held, length):
            if fill >= length - spare:
                rows.append((first + done, fill, pieces))
                done += 1
            else:
                rows.append((None, fill, pieces))
        return rows_to_batch(rows, BINS)

    held: list[tuple[int, bytes]] = []
    for item in items:
        held.append(item)
        if len(held) >= HELD:
            yield give_up(held)
            held = []
    if held:
        yield give_up(held)


OUT = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for sequence, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            offset = 0
            for known, doc_id, piece, start, length, crc in PIECE.iter_unpack(pieces):
                rows.append((doc_id if known else None, piece, start, length, crc, sequence, offset))
                offset += length
        yield rows_to_batch(rows, OUT)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, spare: int = SPARE) -> DataFrame:
    """docs(doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        yield from packed((
            piece for batch in batches
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for piece in pieces_of(doc_id, encode(text) + END, length)), length, spare, 0)

    def again(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from packed((
                item for batch in batches
                for item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), length, spare, level)
        return run

    bins = materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(local, BINS_DDL), "packing-0")
    finished = [bins.where("sequence_id is not null")]
    under = bins.where("sequence_id is null")
    left, level, last = under.count(), 0, False
    while left and not last:
        level += 1
        groups = -(-left // HELD)
        dealt = under.select("fill", "pieces").repartition(groups, F.xxhash64("pieces", F.lit(level)))
        bins = materialise(dealt.mapInArrow(again(level), BINS_DDL), f"packing-{level}")
        finished.append(bins.where("sequence_id is not null"))
        under = bins.where("sequence_id is null")
        before, left = left, under.count()
        last = groups == 1 or left > 0.98 * before
    if left:  # what is under-full now stays so
        level += 1
        finished.append(under.select(
            (F.lit(level << 56) + F.monotonically_increasing_id()).alias("sequence_id"), "fill", "pieces"))
    all_bins = finished[0]
    for more in finished[1:]:
        all_bins = all_bins.union(more)
    return all_bins.select("sequence_id", "pieces").mapInArrow(
        unpack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
