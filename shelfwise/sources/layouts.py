"""JSON objects of a file in any layout, one file read by many tasks.

A feed may be one object per line, an array with an object per line, a pretty-printed array, or an
array on one line. The text source cuts a file at every closing brace, so byte ranges of one file
go to different tasks. Whether a brace is part of a string, and how many objects are open, depends
on all that lies before; each range therefore reports how it changes that state, the reports are
composed in the order of the ranges (one row a range), and then each range is cut into records from the
state it begins with. No text is shuffled but that of the first and last record of a range.

A string ends with its line at the latest, and a line that begins like the file's records do, an
opening brace at the least indentation, starts a record whatever is still open. So a broken record does
not spoil those after it, unless all stand on one line.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import materialise

RANGE = ["file", "block"]
QUOTE, BACKSLASH, LINE, OPEN, CLOSE = b'"\\\n{}'
_MARKS = np.zeros(256, np.uint8)
_MARKS[[QUOTE, BACKSLASH, LINE, OPEN, CLOSE]] = [QUOTE, BACKSLASH, LINE, OPEN, CLOSE]
# What may stand between two records, if it is no longer than this.
_BETWEEN, _SHORT = np.zeros(256, bool), 4
_BETWEEN[list(b" \t\n\v\f\r,[]")] = True


def cuts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value: the text up to a closing brace and that brace; rows of a range come in the order of the file."""
    of_file = lambda name: F.col(f"_metadata.file_{name}")
    return spark.read.option("lineSep", "}").text(path).select(
        F.concat("value", F.lit("}")).alias("value"), of_file("path").alias("file"), of_file("block_start").alias("block"),
        of_file("block_length").alias("length"), of_file("size").alias("size"))


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], dict, bytes]]:
    """For what lies of a range in one batch: the range, its columns, the text. The first line has a line break before it too."""
    begun = None
    for batch in (b for b in batches if b.num_rows):
        changes = [pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in (batch["file"], batch["block"])]
        at = [0, *(np.flatnonzero(changes[0] | changes[1]) + 1).tolist(), batch.num_rows]
        columns = [c for c in batch.schema.names if c != "value"]
        for low, high in pairwise(at):
            values = batch["value"].slice(low, high - low).cast(pa.large_binary())
            _, offsets, data = values.buffers()
            places = np.frombuffer(offsets, np.int64)[values.offset:values.offset + high - low + 1]
            row = {c: batch[c][low].as_py() for c in columns}
            key = row["file"], row["block"]
            text = data.slice(places[0], places[-1] - places[0]).to_pybytes()
            yield key, row, b"\n" + text if key != begun and row["block"] == 0 else text
            begun = key


class Marks(NamedTuple):
    """What decides about strings and records in a text: places and kinds of quotes, line breaks and braces.

    inside: in a string, if the text begins outside one; fresh: whatever it begins in; brace: opens or closes an object
    outside strings; reset: begins a record; starts: where the lines of these begin.
    """

    at: np.ndarray
    kind: np.ndarray
    inside: np.ndarray
    fresh: np.ndarray
    brace: np.ndarray
    reset: np.ndarray
    starts: np.ndarray


def marks(text: bytes, least: int | None) -> Marks:
    found = _MARKS[np.frombuffer(text, np.uint8)]
    at = np.flatnonzero(found)
    kind, order = found[at], np.arange(len(at))
    taken = np.zeros(len(at), bool)
    back = kind == BACKSLASH
    if back.any():
        beside = np.diff(at, prepend=-2) == 1
        first = np.maximum.accumulate(np.where(back & ~(beside & np.roll(back, 1)), order, 0))
        taken = beside & np.roll(back & ((order - first) % 2 == 0), 1)
    starts = np.array([] if least is None else [m.start() + 1 for m in re.finditer(rb"\n[ \t]{%d}\{" % least, text)], np.int64)
    reset = np.zeros(len(at), bool)
    if len(starts):
        reset[np.searchsorted(at, starts + least)] = True
    quotes = np.cumsum((kind == QUOTE) & ~taken)
    last = np.maximum.accumulate(np.where(((kind == LINE) & ~taken) | reset, order, -1))
    fresh = last >= 0
    inside = (quotes - np.where(fresh, quotes[last], 0)) % 2 == 1
    return Marks(at, kind, inside, fresh, ((kind == OPEN) & ~taken) | (kind == CLOSE), reset, starts)


def depths(m: Marks, odd: bool, open_: int) -> tuple[np.ndarray, np.ndarray]:
    """Which marks are braces outside strings, and the objects open after each, where a string and objects are open before."""
    braces = m.brace & (m.inside == (~m.fresh & odd))
    steps = np.where(braces, np.where(m.kind == OPEN, 1, -1), 0)
    total = np.cumsum(steps)
    last = np.maximum.accumulate(np.where(m.reset, np.arange(len(total)), -1))
    return braces, total - np.where(last >= 0, (total - steps)[last], -open_)


def _odd_after(m: Marks, odd: bool) -> bool:
    return bool(m.inside[-1]) if m.fresh[-1] else bool(m.inside[-1]) != odd


def _indents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, least: the least indentation of an opening brace that begins a line of a range; null if none does."""
    for (file, _), runs in groupby(_stretches(batches), itemgetter(0)):
        least = None
        for _, _, text in runs:
            if least != 0:
                widths = [0] if b"\n{" in text else [len(w) for w in re.findall(rb"\n([ \t]*)\{", text)]
                least = min(widths if least is None else [least, *widths], default=None)
        yield pa.RecordBatch.from_pydict({"file": [file], "least": pa.array([least], pa.int32())})


def _reports(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: after it, is a string open (odd0, odd1) and by how much do the open objects change (moves0, moves1),
    if it begins outside or inside a string; anew: the latter counts from a line that begins a record; bytes."""
    for (file, block), runs in groupby(_stretches(batches), itemgetter(0)):
        odd, moves, anew, size = [False, True], [0, 0], False, 0
        for _, row, text in runs:
            m = marks(text, row["least"])
            moves = [int(depths(m, o, n)[1][-1]) for o, n in zip(odd, moves)]
            odd = [_odd_after(m, o) for o in odd]
            anew, size = anew or bool(m.reset.any()), size + len(text)
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": [block], "length": [row["length"]], "size": [row["size"]], "least": pa.array([row["least"]], pa.int32()),
            "bytes": [size - 1 if block == 0 else size], "anew": [anew],
            **{f"odd{i}": pa.array([int(odd[i])], pa.int32()) for i in (0, 1)}, **{f"moves{i}": [moves[i]] for i in (0, 1)}})


def _texts(text: bytes, places: np.ndarray) -> pa.Array:
    """The parts of the text between these places."""
    return pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(text))


def _parts(texts: pa.Array, file: str | None = None, block: int | None = None, part: int | None = None) -> pa.RecordBatch:
    n = len(texts)
    same = [pa.array([v] * n, t) if v is not None else pa.nulls(n, t) for v, t in ((file, pa.string()), (block, pa.int64()), (part, pa.int32()))]
    return pa.RecordBatch.from_arrays([*same, texts], names=["file", "block", "part", "text"])


def _held(runs: Iterable[tuple]) -> Iterator[tuple[dict, bytes]]:
    """The last brace comes alone, and not at all where the file ends without one."""
    held = b""
    for _, row, text in runs:
        yield row, held + text[:-1]
        held = b"}"
    if not row["unfinished"]:
        yield row, held


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text: a record. What goes on from or into another range has its place: file, block, part (0: the end of a record, or
    the midst of one that fills the range; 1: the begin of one)."""
    for (file, block), runs in groupby(_stretches(batches), itemgetter(0)):
        odd, open_, begun, part = None, 0, [], 0
        for row, text in _held(runs):
            if odd is None:
                odd, open_ = bool(row["odd"]), row["open"]
            m = marks(text, row["least"])
            places = m.starts
            if len(m.at):
                braces, depth = depths(m, odd, open_)
                odd, open_ = _odd_after(m, odd), int(depth[-1])
                places = np.union1d(places, m.at[braces & (m.kind == CLOSE) & (depth <= 0)] + 1)
            if not len(places):
                begun.append(text)
                continue
            first = b"".join([*begun, text[:places[0]]])
            first = _texts(first, np.array([0, len(first)]))
            yield _parts(first) if part else _parts(first, file, block, 0)
            lengths, data = np.diff(places), np.frombuffer(text, np.uint8)
            bare = lengths <= _SHORT
            for i in range(_SHORT):
                bare &= (lengths <= i) | _BETWEEN[data[np.minimum(places[:-1] + i, len(data) - 1)]]
            yield _parts(_texts(text, places).filter(pa.array(~bare)))
            begun, part = [text[places[-1]:]], 1
        rest = b"".join(begun)
        yield _parts(_texts(rest, np.array([0, len(rest)])), file, block, part)


def _since(ranges: DataFrame, amount: str, anew: Column, name: str) -> DataFrame:
    """Adds `name`: the sum of `amount` over the earlier ranges of the file, from the last one with `anew` on. One row a range."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.withColumn("_all", F.coalesce(F.sum(amount).over(before), F.lit(0)))
    since = F.coalesce(F.last(F.when(anew, F.col("_all")), ignorenulls=True).over(before), F.lit(0))
    return sums.withColumn(name, F.col("_all") - since).drop("_all")


def ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block, length, least, odd, open, unfinished: the state in which each range begins, and whether the file ends in
    it without a closing brace."""
    # A cut without a line break tells nothing, but the first of a file.
    lines = cuts(spark, path).select("value", *RANGE).where(F.contains("value", F.lit("\n")) | (F.col("block") == 0))
    indents = materialise(lines.mapInArrow(_indents, "file STRING, least INT").groupBy("file").agg(F.min("least").alias("least")), "feed-indents")
    reports = materialise(cuts(spark, path).join(F.broadcast(indents), "file", "left").select("value", *RANGE, "length", "size", "least").mapInArrow(
        _reports, "file STRING, block LONG, length LONG, size LONG, least INT, bytes LONG, anew BOOLEAN, odd0 INT, odd1 INT, moves0 LONG, moves1 LONG"),
        "feed-reports")
    found = _since(reports, "odd0", F.col("odd0") == F.col("odd1"), "odd").withColumn("odd", F.col("odd") % 2)
    found = found.withColumn("moves", F.when(F.col("odd") == 1, F.col("moves1")).otherwise(F.col("moves0")))
    found = _since(found, "moves", F.col("anew"), "open")
    whole = Window.partitionBy("file")
    unfinished = (F.sum("bytes").over(whole) > F.col("size")) & (F.col("block") == F.max("block").over(whole))
    return materialise(found.select(*RANGE, "length", "least", "odd", "open", unfinished.alias("unfinished")), "feed-ranges")


def objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """text: one row for each object, or what stands for one, of the files."""
    known = F.broadcast(ranges(spark, path).withColumnRenamed("length", "known"))
    # The ranges are the scan's; should they be cut anew between two passes, the query ends.
    odd = F.when(F.col("known") == F.col("length"), F.col("odd")).otherwise(
        F.raise_error(F.concat(F.lit("other ranges than before in "), "file")).cast("long"))
    found = materialise(cuts(spark, path).join(known, RANGE, "left").select(
        "value", *RANGE, "least", odd.alias("odd"), "open", "unfinished").mapInArrow(
        _records, "file STRING, block LONG, part INT, text STRING"), "feed-records")
    # One or two rows a range; a record that begins in a range ends with the next row that does not begin one.
    place = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0)
    edges = found.where("file IS NOT NULL").withColumn("record", F.sum("part").over(place)).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
    joined = edges.select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    texts = found.where("file IS NULL").select("text").unionByName(joined)
    bare = F.regexp_replace(F.regexp_replace("text", r"^[\s,\[\]\x{FEFF}]+", ""), r"[\s,]+$", "")
    return texts.select(bare.alias("text")).where("text <> ''")


def read(spark: SparkSession, path: str | list[str], schema: T.StructType, bad: str) -> DataFrame:
    """The objects as records; those that do not parse keep their text in column `bad`."""
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json("text", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return objects(spark, path).select(parsed.alias("r")).select("r.*")
