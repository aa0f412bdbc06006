"""The prefix trie of conversations, with subtree totals by time-forward processing.

Rebuilding and paths: turns are numbered in a range-partitioned order, so a long conversation spreads
over tasks. A turn is known by the md5 of role and text from the first scan on; texts never move.
A node is known by its depth and two 64-bit hashes: the exclusive or, over the path, of hashes of
(place, turn), which is summed up from runs and so needs no conversation in one task. Later a
node's name is (its smallest member, its depth); the parent's lies on the same member's path.

Totals: the nodes are cut into shards, connected pieces with one top: a node is of stratum k if it
has at most FAN ** k members, and a shard is a piece of one stratum (and of BAND levels, for very long
conversations). So per level a shard has no more than FAN nodes. A shard's nodes are sorted by
Spark in reverse level order; each takes what its children sent, and sends its subtree's totals forward
to its parent through a priority queue, which writes sorted runs to the shared folder when it is
large. What the tops of shards send crosses to the shards above, summed by parent before, and
these are processed next: as many rounds as there are strata, four for some billions of conversations.

Defined results: rows with null conv_id are left out; null role or text is empty; null turns come first;
turns that repeat a number stand in the order of the md5 of their length-prefixed role and text; repeated
rows are turns of their own; % keeps the sign, as in SQL; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import fold, global_index, rows_to_batch
from shelfwise.session import materialise, scratch_path

GROUP = 100
SHARED = 6
FAN = 256
BAND = 1 << 20
# Entries of a queue held in memory.
QUEUE = 200_000
# Ids of one piece of text that is hashed.
PIECE = 65_536


# ---------------------------------------------------------------- rebuilt conversations

def turns(conversations: DataFrame) -> DataFrame:
    """conversations -> conv_id, place (from 1), turn_key, chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    thin = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").alias("turn_no"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_key"),
        F.char_length(text).cast("long").alias("chars"))
    order = [F.col("conv_id"), F.col("turn_no").asc_nulls_first(), F.col("turn_key")]
    return global_index(thin, order, ["conv_id"], "trie-turns", "place").select("conv_id", "place", "turn_key", "chars")


def rebuilt(placed: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % group, h = crc32(c) % shared,
    and goes on with its own turns after the first h -> conv_id, depth, turn_key, chars."""
    base, h = F.col("conv_id") - F.col("conv_id") % group, fold("conv_id", shared)
    heads = materialise(
        placed.where((F.col("conv_id") % group == 0) & (F.col("place") < shared)).withColumnRenamed("conv_id", "base"), "trie-heads")
    sizes = heads.groupBy("base").agg(F.max("place").alias("size"))
    ids = placed.select("conv_id").distinct().withColumn("base", base)
    first = ids.join(heads, "base").where(F.col("place") <= h).select("conv_id", F.col("place").alias("depth"), "turn_key", "chars")
    taken = F.least(h, F.coalesce("size", F.lit(0)))
    own = placed.where(F.col("place") > h).withColumn("base", base).join(materialise(sizes, "trie-sizes"), "base", "left").select(
        "conv_id", (F.col("place") - h + taken).alias("depth"), "turn_key", "chars")
    return first.unionByName(own)


# ---------------------------------------------------------------- nodes

def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, depth, chars, a, b) in order -> a and b become the exclusive or of those so far in
    the conversation, in this partition."""
    part, conv, held = TaskContext.get().partitionId(), None, [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, convs[1:] != convs[:-1]])
        sizes, out = np.diff(np.r_[starts, len(convs)]), []
        for i in (0, 1):
            sums = np.bitwise_xor.accumulate(batch.column(3 + i).to_numpy())
            before = np.r_[np.int64(0), sums[starts[1:] - 1]]
            if convs[0] == conv:
                before[0] ^= held[i]
            sums = sums ^ np.repeat(before, sizes)
            held[i] = sums[-1]
            out.append(pa.array(sums))
        conv = convs[-1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *out, pa.array(np.full(len(convs), part, np.int64))], names=["conv_id", "depth", "chars", "a", "b", "part"])


def paths(turn_rows: DataFrame) -> DataFrame:
    """conv_id, depth, chars, a, b: (depth, a, b) stands for the sequence of the first `depth` turns."""
    hashed = turn_rows.select("conv_id", "depth", "chars", *[F.xxhash64(F.lit(i), "depth", "turn_key").alias(n) for i, n in ((1, "a"), (2, "b"))])
    stored = materialise(
        hashed.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
        .mapInArrow(running, "conv_id long, depth long, chars long, a long, b long, part long"), "trie-paths")
    # What the earlier parts of a conversation add up to: a row for each cut through one, at most one a part.
    own = hashed.select("conv_id", "depth", F.col("a").alias("xa"), F.col("b").alias("xb"))
    cut = stored.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("conv_id")
    runs = stored.join(cut, "conv_id").join(own, ["conv_id", "depth"]).groupBy("conv_id", "part").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select("conv_id", "part", *[F.coalesce(F.bit_xor(f"x{n}").over(earlier), F.lit(0)).alias(f"c{n}") for n in "ab"])
    return stored.join(carried, ["conv_id", "part"], "left").select(
        "conv_id", "depth", "chars", *[F.col(n).bitwiseXOR(F.coalesce(f"c{n}", F.lit(0))).alias(n) for n in "ab"])


def stratum(members: Column, fan: int) -> Column:
    found = F.lit(63)
    for k in reversed(range(1, 63)):
        if fan ** k < 1 << 63:
            found = F.when(members <= fan ** k, F.lit(k)).otherwise(found)
    return found


def named(path_rows: DataFrame, fan: int, band: int) -> DataFrame:
    """Each row's node: conv_id, depth, node (smallest member), n_convs, chars, stratum, band."""
    path_rows = materialise(path_rows, "trie-hashes")
    # stored, so that a node with very many members can be split in the join
    nodes = materialise(path_rows.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    return materialise(path_rows.join(nodes, ["depth", "a", "b"]).select(
        "conv_id", "depth", "node", "n_convs", "chars", stratum(F.col("n_convs"), fan).alias("stratum"),
        F.floor(F.col("depth") / band).alias("band")), "trie-members")


def sharded(rows: DataFrame, root: int, members: int, fan: int) -> DataFrame:
    """One row a node but the root: conv_id, depth, parent, n_convs, own, stratum, band, and its shard's top: top, top_depth."""
    last = next(k for k in range(1, 64) if members <= fan ** k)
    tops = rows.groupBy("conv_id", "stratum", "band").agg(F.min("depth").alias("top_depth"), F.min("node").alias("top"))
    of_root = (F.col("stratum") == last) & (F.col("band") == 0)
    tops = materialise(tops.select(
        "conv_id", "stratum", "band", F.when(of_root, F.lit(0)).otherwise(F.col("top_depth")).alias("top_depth"),
        F.when(of_root, F.lit(root)).otherwise(F.col("top")).alias("top")), "trie-tops")
    above = rows.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = rows.where("conv_id = node").drop("node")
    return (
        nodes.join(above, ["conv_id", "depth"], "left").join(tops, ["conv_id", "stratum", "band"])
        .select("conv_id", "depth", F.coalesce("parent", F.lit(root)).alias("parent"), "n_convs",
                ((F.col("n_convs") - 1) * F.col("chars")).alias("own"), "stratum", "band", "top", "top_depth"))


# ---------------------------------------------------------------- time-forward processing

MESSAGE = pa.schema([(n, pa.int64()) for n in ("level", "node", "children", "leaves", "saved")])


class SpillingQueue:
    """A priority queue of number tuples that writes sorted runs to a folder beyond `most` entries."""

    def __init__(self, folder: str, most: int = QUEUE):
        self.folder, self.most, self.heap, self.runs = folder, most, [], []

    def push(self, entry: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) >= self.most:
            self.spill()

    def spill(self) -> None:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(self.folder)
        files.create_dir(path, recursive=True)
        path = f"{path}/{uuid.uuid4().hex}"
        self.heap.sort()
        with files.open_output_stream(path) as out, pa.ipc.new_stream(out, MESSAGE) as writer:
            for at in range(0, len(self.heap), 10_000):
                writer.write_batch(rows_to_batch(self.heap[at:at + 10_000], MESSAGE))
        self.heap = []
        run = self.entries(files, path)
        heapq.heappush(self.runs, (next(run), len(self.runs), run))

    @staticmethod
    def entries(files, path: str) -> Iterator[tuple[int, ...]]:
        with files.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
            for batch in reader:
                yield from zip(*(c.to_pylist() for c in batch.columns))
        files.delete_file(path)

    def peek(self) -> tuple[int, ...] | None:
        tops = ([self.heap[0]] if self.heap else []) + ([self.runs[0][0]] if self.runs else [])
        return min(tops) if tops else None

    def pop(self) -> tuple[int, ...]:
        if self.heap and (not self.runs or self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        entry, number, run = self.runs[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (following, number, run))
        return entry


TOTALS = pa.schema([(n, pa.int64()) for n in ("conv_id", "depth", "parent", "n_convs", "children", "leaves", "saved", "inner")])


def upwards(folder: str, most: int):
    """Rows (top, top_depth, depth, conv_id, parent, n_convs, children, leaves, saved), shards one after the
    other, each in reverse level order -> totals. What a row has of the last three came from shards below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard = SpillingQueue(folder, most), None
        for batch in batches:
            rows = []
            for top, top_depth, depth, conv, parent, n_convs, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                if (top, top_depth) != shard:
                    queue, shard = SpillingQueue(folder, most), (top, top_depth)
                while (first := queue.peek()) and first[:2] == (-depth, conv):
                    _, _, more_children, more_leaves, more_saved = queue.pop()
                    children, leaves, saved = children + more_children, leaves + more_leaves, saved + more_saved
                leaves = leaves if children else 1
                inner = depth > top_depth
                if inner:
                    queue.push((1 - depth, parent, 1, leaves, saved))
                rows.append((conv, depth, parent, n_convs, children, leaves, saved, int(inner)))
            yield rows_to_batch(rows, TOTALS)

    return run


def totals(nodes: DataFrame, folder: str, most: int = QUEUE) -> DataFrame:
    """All nodes with children, leaves and saved of their subtrees; shards of low strata and deep bands first."""
    rounds = sorted((r["stratum"], -r["band"]) for r in nodes.select("stratum", "band").distinct().collect())
    sent, done = None, None
    for k, deep in rounds:
        here = nodes.where((F.col("stratum") == k) & (F.col("band") == -deep))
        if sent is not None:
            here = here.join(sent.groupBy("conv_id", "depth").agg(*[F.sum(n).alias(n) for n in ("children", "leaves", "saved")]), ["conv_id", "depth"], "left")
        else:
            here = here.withColumns({n: F.lit(0).cast("long") for n in ("children", "leaves", "saved")})
        none = F.lit(0)
        ordered = (
            here.select(
                "top", "top_depth", "depth", "conv_id", "parent", "n_convs", F.coalesce("children", none).alias("children"),
                F.coalesce("leaves", none).alias("leaves"), (F.coalesce("saved", none) + F.col("own")).alias("saved"))
            .repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", F.col("depth").desc(), "conv_id"))
        found = materialise(ordered.mapInArrow(upwards(folder, most), ", ".join(f"{f.name} long" for f in TOTALS)), "trie-totals")
        crossing = found.where("inner = 0 and depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
            F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        crossing = materialise(crossing, "trie-crossing")
        sent = crossing if sent is None else sent.unionByName(crossing)
        done = found if done is None else done.unionByName(found)
    return done


# ---------------------------------------------------------------- members that end at a node

def joined_ids(size: int):
    """Rows (node, depth, conv_id) in order -> (node, depth, first id, ids joined by commas), `size` ids at most."""
    schema = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            rows = []
            for node, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((node, depth) != at or len(held) >= size):
                    rows.append((*at, held[0], ",".join(map(str, held))))
                    held = []
                at = (node, depth)
                held.append(conv)
            yield rows_to_batch(rows, schema)
        if held:
            yield rows_to_batch([(*at, held[0], ",".join(map(str, held)))], schema)

    return run


def hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, depth, first id, ids) in order -> one SHA-256 a node; no node is held whole."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    at, digest = None, None
    for batch in batches:
        rows = []
        for node, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (node, depth) == at:
                digest.update(b",")
            else:
                if at:
                    rows.append((*at, digest.hexdigest()))
                at, digest = (node, depth), hashlib.sha256()
            digest.update(ids.encode())
        yield rows_to_batch(rows, schema)
    if at:
        yield rows_to_batch([(*at, digest.hexdigest())], schema)


def ends(rows: DataFrame, ids: DataFrame, root: int, size: int = PIECE) -> DataFrame:
    """(conv_id, depth, ends_sha256) of nodes where conversations end."""
    lengths = ids.join(rows.groupBy("conv_id").agg(F.max("depth").alias("depth")), "conv_id", "left")
    last = lengths.join(rows.select("conv_id", "depth", "node"), ["conv_id", "depth"], "left").select(
        F.coalesce("node", F.lit(root)).alias("node"), F.coalesce("depth", F.lit(0)).alias("depth"), "conv_id")
    order = ["node", "depth", "conv_id"]
    pieces = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined_ids(size), "node long, depth long, first long, ids string")
    return pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "first").mapInArrow(
        hashed_ids, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, fan: int = FAN, band: int = BAND, queue: int = QUEUE, piece: int = PIECE) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> a row per node: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    placed = materialise(turns(conversations), "trie-placed")
    ids = materialise(placed.select("conv_id").distinct(), "trie-ids")
    root, members = ids.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not members:
        return spark.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    rows = named(paths(materialise(rebuilt(placed), "trie-rebuilt")), fan, band)
    last = next(k for k in range(1, 64) if members <= fan ** k)
    top = spark.createDataFrame(
        [(root, 0, None, members, 0, last, 0, root, 0)],
        "conv_id long, depth long, parent long, n_convs long, own long, stratum int, band long, top long, top_depth long")
    nodes = materialise(sharded(rows, root, members, fan).unionByName(top), "trie-shards")
    found = totals(nodes, scratch_path(spark, "trie-queues"), queue)
    return found.join(ends(rows, ids, root, piece), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
