"""Near-duplicate vectors by NN-descent.

Method: every vector keeps a list of its nearest neighbours of the same label. Lists begin with
neighbours in several orders of sign sketches, then are refined in rounds: neighbours of a vector
(either way) are compared with each other, and whoever is closer than the furthest in the other's
list enters it. A list full of possible links is saturated and gets twice the places. A bounded
sample, drawn anew each turn, half of it from vectors in the smallest components, is compared with all vectors.
A sampled vector counts as missed if any of its links leads to another component. Turns with
twice the orders follow until two samples in a row have none missed. Should that not come about,
all vectors of a label are compared across components, in blocks, so nothing found missing is left over.
Pairs at the threshold or above, by exact cosine, link their vectors.

Neighbours are ranked by the distance of 512-bit sketches; cosines are computed in double
precision for pairs whose sketches are near enough (a link's are, but for one pair in 10 ** 15).
Equal vectors are one node with a number of copies. Links found join vectors to components; within
a component all links are then counted exactly, in blocks of bounded size, and only counts are
emitted, never the pairs.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows
without a label, have no links and are components of their own; so do vectors of another length.
Repeated rows are vectors of their own, linked as copies. A null vec_id takes part but names a
component only if there is no other id. An empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import components, global_index
from shelfwise.session import materialise

LEAST = 0.93
BITS = 512
NEAR_BITS = 128  # sketches of vectors at cosine 0.93 differ in 61 bits on average, deviation 7.3
PLACES, MOST_PLACES = 8, 64
ORDER_BITS, ORDERS, REACH = 32, 8, 4
ROUNDS = 6
AUDITED = 512
TURNS, CLEAN = 6, 2
BLOCK = 1024

PREPARED = "row long, vec_id long, label long, dim int, unit binary, sketch binary"
EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("d", pa.int32())])
EDGE_DDL = "u long, v long, d int"


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, BITS))


def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vec_id, label, embedding) -> unit vectors and sketches; null for vectors without links."""
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        vectors = batch.column(3).to_pylist()
        labels, dims, units, sketches = batch.column(2).to_pylist(), [], [], []
        for label, vector in zip(labels, vectors):
            unit = unit_of(vector) if label is not None else None
            dims.append(None if unit is None else len(unit))
            units.append(None if unit is None else unit.tobytes())
            if unit is None:
                sketches.append(None)
                continue
            if len(unit) not in known:
                known[len(unit)] = planes(len(unit))
            sketches.append(np.packbits(unit @ known[len(unit)] > 0).tobytes())
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), batch.column(2), pa.array(dims, pa.int32()), pa.array(units, pa.binary()),
            pa.array(sketches, pa.binary())], names=["row", "vec_id", "label", "dim", "unit", "sketch"])


def unit_of(vector) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    x = np.array(vector, np.float64)
    largest = np.abs(x).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    x = x / largest
    return x / np.sqrt(x @ x)


def sketch_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int32)


def runs_of(batches: Iterator[pa.RecordBatch], keys: int, most: int | None = None) -> Iterator[pa.Table]:
    """Rows with the same first `keys` columns, which come together; in pieces of `most` rows."""
    held, rows, current = [], 0, None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(max(len(batch) - 1, 0), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1), len(batch)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            key = tuple(c[low] for c in columns)
            if held and (key != current or most and rows >= most):
                yield pa.Table.from_batches(held)
                held, rows = [], 0
            current = key
            held.append(batch.slice(low, high - low))
            rows += high - low
    if held:
        yield pa.Table.from_batches(held)


def by_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (order, label, dim, node, sketch), sorted: each node's two best in reach, and all near ones."""
    for run in runs_of(batches, 3, 20_000):
        node, sketch = run.column(3).to_numpy(), sketch_matrix(run.column(4))
        n = len(node)
        found = np.full((n, 2 * REACH), BITS + 1, np.int32)
        other = np.zeros((n, 2 * REACH), np.int64)
        for step in range(1, min(REACH, n - 1) + 1):
            d = distance(sketch[:-step], sketch[step:])
            found[:-step, step - 1], other[:-step, step - 1] = d, node[step:]
            found[step:, REACH + step - 1], other[step:, REACH + step - 1] = d, node[:-step]
        best = np.argsort(found, axis=1)[:, :2]
        keep = found <= NEAR_BITS
        np.put_along_axis(keep, best, True, axis=1)
        keep &= found <= BITS
        at, step = np.nonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(other[at, step]), pa.array(found[at, step])], schema=EDGE)


def order_code(order: int) -> Column:
    """Bytes of a sketch, led by another byte in each of 64 orders, and in steps that differ after 16."""
    size, per_round = BITS // 8, BITS // ORDER_BITS
    lap, start = divmod(order, per_round)
    at = [(ORDER_BITS // 8 * start + lap + k * (2 * lap + 1)) % size for k in range(ORDER_BITS // 4)]
    return F.concat(*[F.substring("sketch", i + 1, 1) for i in at])


def ordered_candidates(nodes: DataFrame, first: int, orders: int) -> DataFrame:
    """Candidates from neighbours in `orders` orders of the sketches, each led by other bits."""
    places = [F.struct(F.lit(first + i).alias("order"), order_code(first + i).alias("code")) for i in range(orders)]
    rows = nodes.select(F.explode(F.array(*places)).alias("o"), "label", "dim", "node", "sketch").select("o.order", "label", "dim", "o.code", "node", "sketch")
    keys = ["order", "label", "dim", "code", "node"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("code").mapInArrow(by_order, EDGE_DDL)


def local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (centre, v, sketch, furthest), sorted by centre: pairs of a centre's neighbours that
    would enter either's list."""
    for run in runs_of(batches, 1):
        node, sketch, furthest = run.column(1).to_numpy(), sketch_matrix(run.column(2)), run.column(3).to_numpy()
        d = distance(sketch[:, None], sketch[None])
        a, b = np.nonzero((d < furthest[:, None]) & (node[:, None] != node[None]))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b]), pa.array(d[a, b])], schema=EDGE)


def nearest(candidates: DataFrame, lists: DataFrame) -> DataFrame:
    """The candidates that are among the nearest of u, as many as its list has places."""
    each = candidates.groupBy("u", "v").agg(F.min("d").alias("d"))
    place = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return (
        each.withColumn("place", place).where(F.col("place") <= MOST_PLACES)
        .join(lists.select(F.col("node").alias("u"), "places"), "u").where("place <= places").select("u", "v", "d"))


def refine(nodes: DataFrame, graph: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round -> (graph, lists). lists(node, places): how many neighbours a node keeps."""
    ends = graph.groupBy("u").agg(F.max("d").alias("furthest"), F.count(F.lit(1)).alias("n"))
    # a list with free places takes whoever comes, a full one who is closer
    state = (
        nodes.select("node", "sketch").join(lists, "node").join(ends.withColumnRenamed("u", "node"), "node", "left")
        .select(F.col("node").alias("v"), "sketch", F.when(F.col("n") >= F.col("places"), F.col("furthest")).otherwise(BITS + 1).alias("furthest")))
    both = graph.union(graph.select("v", "u", "d")).groupBy("u", "v").agg(F.min("d").alias("d"))
    bound = Window.partitionBy("u").orderBy("d", "v")
    centred = both.withColumn("place", F.row_number().over(bound)).where(F.col("place") <= 2 * MOST_PLACES)
    allowed = centred.join(lists.select(F.col("node").alias("u"), "places"), "u").where("place <= 2 * places")
    pairs = (
        allowed.select("u", "v").join(state, "v").select("u", "v", "sketch", "furthest")
        .repartition("u").sortWithinPartitions("u").mapInArrow(local_join, EDGE_DDL))
    fresh = materialise(nearest(graph.union(pairs), lists), "nn-graph")
    full = fresh.groupBy("u").agg(F.sum((F.col("d") <= NEAR_BITS).cast("int")).alias("near"))
    grown = lists.join(full.withColumnRenamed("u", "node"), "node", "left").select("node", F.when(
        F.coalesce("near", F.lit(0)) >= F.col("places"), F.least(F.col("places") * 2, F.lit(MOST_PLACES))).otherwise(F.col("places")).alias("places"))
    return fresh, materialise(grown, "nn-lists")


def exact(edges: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Those of edges(u, v) whose cosine is at least `least`."""
    def run(batches):
        for batch in batches:
            dot = [float(np.frombuffer(a) @ np.frombuffer(b)) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(np.array(dot) >= least, pa.bool_()))

    pairs = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    one = nodes.select(F.col("node").alias("u"), F.col("unit").alias("one"))
    two = nodes.select(F.col("node").alias("v"), F.col("unit").alias("two"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "one", "two").mapInArrow(run, "a long, b long")


def audit(nodes: DataFrame, joined: DataFrame, least: float, turn: int, size: int = AUDITED) -> DataFrame:
    """Links between different components that a sample of nodes has, against all nodes.

    joined(node, component). Half of the sample is from all nodes, half from the smallest components,
    where a missed link is most of what there is.
    """
    sizes = joined.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    sized = nodes.join(joined.join(sizes, "component"), "node", "left").select("node", "label", "dim", "unit", F.coalesce("n", F.lit(1)).alias("n"))
    drawn = F.xxhash64("node", F.lit(turn))
    small = F.greatest("n", F.lit(2))  # whoever is alone, or has one partner, comes first
    chosen = (
        sized.orderBy(drawn).limit(size // 2).union(sized.orderBy(small, F.xxhash64("node", F.lit(-1 - turn))).limit(size // 2))
        .dropDuplicates(["node"]).collect())
    groups: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r["label"], r["dim"]) for r in chosen}:
        own = [r for r in chosen if (r["label"], r["dim"]) == key]
        groups[key] = np.array([r["node"] for r in own]), np.array([np.frombuffer(r["unit"]) for r in own])
    shared = nodes.sparkSession.sparkContext.broadcast(groups)

    def run(batches):
        for batch in batches:
            label, dim, node = (batch.column(i).to_numpy() for i in range(3))
            unit = batch.column(3).to_pylist()
            for key, (ids, asked) in shared.value.items():
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if len(at):
                    there = np.frombuffer(b"".join([unit[i] for i in at])).reshape(len(at), -1)
                    one, two = np.nonzero((asked @ there.T >= least) & (ids[:, None] != node[at][None]))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[one]), pa.array(node[at[two]])], names=["a", "b"])

    true = nodes.select("label", "dim", "node", "unit").mapInArrow(run, "a long, b long")
    of = joined.withColumnRenamed("node", "a").withColumnRenamed("component", "ca")
    to = joined.withColumnRenamed("node", "b").withColumnRenamed("component", "cb")
    missed = true.join(of, "a", "left").join(to, "b", "left").where("ca is null or cb is null or ca <> cb").select("a", "b")
    return materialise(missed, "nn-missed")


def in_blocks(placed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with a `place` (from 1) in their group, sent to each pair (i, j) of blocks of the group they belong to."""
    placed = placed.withColumn("block", ((F.col("place") - 1) / BLOCK).cast("int"))
    sizes = placed.groupBy(*keys).agg((F.max("block") + 1).alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = placed.join(sizes, keys).select(*keys, other.alias("other"), "block", *columns).select(
        *keys, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *columns)
    return spread.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j", "node")


def across(nodes: DataFrame, joined: DataFrame, least: float) -> DataFrame:
    """All links (a, b) between different components: every two vectors of a label, in blocks."""
    own = nodes.join(joined, "node", "left").select("label", "dim", "node", F.coalesce("component", "node").alias("component"), "unit")
    placed = global_index(own, [F.col("label"), F.col("dim"), F.col("component"), F.col("node")], ["label", "dim"], "nn-all", "place")

    def run(batches):
        for table in runs_of(batches, 4):
            i, j = table.column(2)[0].as_py(), table.column(3)[0].as_py()
            block, node, component = (table.column(k).to_numpy() for k in (4, 5, 6))
            unit = np.frombuffer(b"".join(table.column(7).to_pylist())).reshape(len(node), -1)
            one, two = block == i, block == j
            near = (unit[one] @ unit[two].T >= least) & (component[one][:, None] != component[two][None])
            a, b = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array(node[one][a]), pa.array(node[two][b])], names=["a", "b"])

    return materialise(in_blocks(placed, ["label", "dim"], ["node", "component", "unit"]).mapInArrow(run, "a long, b long"), "nn-across")


COUNTS = pa.schema([("node", pa.int64()), ("n", pa.int64())])


def count_links(members: DataFrame, least: float) -> DataFrame:
    """members(node, component, unit, copies) -> (node, n): copies of all linked nodes, its own included."""
    placed = global_index(members, [F.col("component"), F.col("node")], ["component"], "nn-members", "place")

    def run(batches):
        for table in runs_of(batches, 3):
            i = table.column(1)[0].as_py()
            block, node, copies = (table.column(k).to_numpy() for k in (3, 4, 6))
            unit = np.frombuffer(b"".join(table.column(5).to_pylist())).reshape(len(node), -1)
            rows, columns = block == i, block == table.column(2)[0].as_py()
            near = unit[rows] @ unit[columns].T >= least
            if (block == i).all():
                np.fill_diagonal(near, True)
                parts = [(node, near @ copies)]
            else:
                parts = [(node[rows], near @ copies[columns]), (node[columns], copies[rows] @ near)]
            for ids, n in parts:
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], schema=COUNTS)

    pairs = in_blocks(placed, ["component"], ["node", "unit", "copies"])
    return pairs.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def link(vectors: DataFrame, least: float = LEAST, turns: int = TURNS) -> DataFrame:
    """vectors(vec_id, label, embedding) -> vec_id, n_links, component_id, kept.

    After `turns` turns without enough clean audits, the vectors are compared across components.
    """
    given = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    rows = materialise(given.mapInArrow(prepare, PREPARED), "nn-vectors")
    same = ["label", "dim", "unit"]
    nodes = materialise(
        rows.where("unit is not null").groupBy(*same).agg(
            F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch")), "nn-nodes")
    lists = materialise(nodes.select("node", F.lit(PLACES).alias("places")), "nn-lists")
    seen = graph = joined = None
    clean = 0
    for turn in range(turns):
        done = ORDERS * (2 ** turn - 1)
        more = materialise(ordered_candidates(nodes, done, ORDERS * 2 ** turn), "nn-candidates")
        near = more.where(F.col("d") <= NEAR_BITS)
        graph = materialise(nearest(more if graph is None else graph.union(more), lists), "nn-graph")
        before = None
        for _ in range(ROUNDS):
            graph, lists = refine(nodes, graph, lists)
            now = graph.agg(F.count(F.lit(1)), F.sum("d")).first()
            if before and now[0] == before[0] and (now[1] or 0) > 0.995 * (before[1] or 0):
                break
            before = now
        near = near.union(graph.where(F.col("d") <= NEAR_BITS)).select("u", "v")
        found = exact(near, nodes, least)
        seen = materialise(found if seen is None else found.union(seen), "nn-links")
        joined = materialise(components(seen, "nn"), "nn-components")
        missed = audit(nodes, joined, least, turn)
        if missed.isEmpty():
            clean += 1
        else:  # what the audit has found counts as well
            clean = 0
            seen = materialise(seen.union(missed), "nn-links")
            joined = materialise(components(seen, "nn"), "nn-components")
        if clean == CLEAN:
            break
    else:
        seen = seen.union(across(nodes, joined, least))
        joined = materialise(components(seen, "nn"), "nn-components")
    counts = count_links(nodes.join(joined, "node").select("node", "component", "unit", "copies"), least)
    of_nodes = nodes.join(joined, "node", "left").join(counts, "node", "left").select(
        *same, F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.col("copies")) - 1).alias("n_links"))
    linked = rows.where("unit is not null").select("vec_id", *same).join(of_nodes, same).select("vec_id", "n_links", "component")
    linked = materialise(linked, "nn-linked")
    least_id = linked.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    alone = rows.where("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked.join(least_id, "component").select("vec_id", "n_links", "component_id").union(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
