"""SimHash near-duplicates with a Gray-order hierarchical index.

Method: fingerprints within `most` differing bits are found in groups that share a masked bit
pattern. Two fingerprints that differ in at most 2 bits agree in one of three parts of the bits,
so each part's pattern is an upper node with nothing accumulated yet; a node with too many
members gets lower nodes by the same rule on the bits still free, until a group fits a task.
Within a group fingerprints are sorted by Gray rank, so neighbours share long patterns; runs of
neighbours form nodes which hold the bits all their members share beyond those of their parent.
A search adds up the differences on its way down and drops a whole node beyond the limit.

Equal fingerprints are one entry, and a group gives a spanning forest of its links only, so copies
are never expanded into pairs. Groups of links are then joined in rounds.

Defined results: null text and text without words have fingerprint 0, linked like any other;
repeated rows and ties share fingerprint and group; a null doc_id takes part, but names a group
only if there is no other id (null then); an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import components, rows_to_batch, text_bytes
from shelfwise.session import materialise

BITS = 64
SHINGLE = 3
SEED = 42
MOST = 2
# A group with more members gets lower nodes.
GROUP = 50_000
# A node with so few free bits is not split further: it has 2 ** 20 members at most.
LEAST_FREE = 20
FAN = 8
CHUNK = 4096


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    words = text_bytes(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b - 1], seed) for a, b in zip(starts, ends[width - 1:] or ends[-1:])), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """docs -> keys and long `fp`, the fingerprint's bits."""
    schema = pa.schema([("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
            columns = [batch.column(i) for i in range(len(keys))] + [pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, schema[0].name])

    given = docs.select(*keys, F.col("text").cast("binary").alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]) + ", fp long"
    return given.mapInArrow(run, ddl)


# ---------------------------------------------------------------- the index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(shift))
    return codes


def tree(codes: np.ndarray, fan: int = FAN) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the top: for each node the bits its members share beyond its parent's, and their
    values. codes are sorted by Gray rank; the last level are the codes themselves."""
    every, some = codes, codes
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    while len(every) > 1:
        starts = np.arange(0, len(every), fan)
        every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
        levels.append((~(every ^ some), every))
    levels.reverse()
    own = [levels[0]]
    for (above, _), (shared, values) in zip(levels, levels[1:]):
        own.append((shared & ~np.repeat(above, fan)[:len(shared)], values))
    return own


def search(levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, most: int, fan: int = FAN) -> tuple[np.ndarray, np.ndarray]:
    """(query place, code place) of all pairs within `most` bits."""
    query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    spent = np.zeros(len(queries), np.int64)
    for depth, (shared, values) in enumerate(levels):
        if depth:
            query, spent = np.repeat(query, fan), np.repeat(spent, fan)
            node = (np.repeat(node, fan) * fan + np.tile(np.arange(fan), len(node)))
            there = node < len(values)
            query, node, spent = query[there], node[there], spent[there]
        spent = spent + np.bitwise_count((queries[query] ^ values[node]) & shared[node])
        near = spent <= most
        query, node, spent = query[near], node[near], spent[near]
    return query, node


def forest(codes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the codes (all different) within `most` bits."""
    codes = codes[np.argsort(gray_rank(codes))]
    levels, parent, links = tree(codes), list(range(len(codes))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(0, len(codes), CHUNK):
        query, found = search(levels, codes[at:at + CHUNK], most)
        query = query + at
        later = found > query
        for a, b in zip(query[later].tolist(), found[later].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[y] = x
                links.append((a, b))
    signed = codes.view(np.int64).tolist()
    return [(signed[a], signed[b]) for a, b in links]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def group_links(most: int):
    """Rows (mask, value, fp) of a partition, groups consecutive -> links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            mask, value, fp = (batch.column(i).to_numpy() for i in range(3))
            edges = [0, *(np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1), len(mask)]
            rows = []
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if held and (mask[low], value[low]) != key:
                    rows += whole(held)
                    held = []
                key = (mask[low], value[low])
                held.append(fp[low:high])
            yield rows_to_batch(rows, LINKS)
        yield rows_to_batch(whole(held), LINKS)

    def whole(held: list[np.ndarray]) -> list[tuple[int, int]]:
        if sum(map(len, held)) < 2:
            return []
        return forest(np.concatenate(held).view(np.uint64), most)

    return run


def split_bits(mask: int, parts: int) -> list[int]:
    """The mask with one of `parts` equal shares of its free bits added, for each share."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[low:high]) for low, high in zip(cuts, cuts[1:])]


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def lower_nodes(rows: DataFrame, masks: list[int], most: int) -> DataFrame:
    """Each (mask, fp) goes to the nodes below it: their mask, the pattern there, and fp."""
    children = F.lit(None)
    for mask in masks:
        children = F.when(F.col("mask") == signed(mask), F.array(*[F.lit(signed(m)).cast("long") for m in split_bits(mask, most + 1)])).otherwise(children)
    return rows.select(F.explode(children).alias("mask"), "fp").select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")


def links(fps: DataFrame, most: int = MOST, group: int = GROUP) -> DataFrame:
    """fps(fp), all different -> links (a, b) that connect whatever is connected within `most` bits."""
    masks, found = [0], None
    rows = lower_nodes(fps.select(F.lit(0).cast("long").alias("mask"), "fp"), masks, most)
    while True:
        masks = [m for mask in masks for m in split_bits(mask, most + 1)]
        rows = materialise(rows, "simhash-nodes")
        full = materialise(rows.groupBy("mask", "value").count().where(F.col("count") > group).drop("count"), "simhash-full")
        splits = all(BITS - bin(m).count("1") > LEAST_FREE for m in masks)
        crowded = splits and full.limit(1).count() > 0
        fit = rows.join(full, ["mask", "value"], "left_anti") if crowded else rows
        here = (fit.select("mask", "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value")
                .mapInArrow(group_links(most), "a long, b long"))
        found = here if found is None else found.union(here)
        if not crowded:
            return found
        rows = lower_nodes(rows.join(full, ["mask", "value"], "left_semi"), masks, most)


def grouped(docs: DataFrame, keys: list[str], most: int = MOST) -> DataFrame:
    """docs(keys, text) -> keys, fp, root: rows with the same root are linked."""
    prints = materialise(fingerprints(docs, keys), "simhash-prints")
    fps = prints.select("fp").distinct()
    roots = components(links(fps, most), "simhash")
    return (
        prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select(*keys, "fp", F.coalesce("component", "fp").alias("root")))


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, most: int = MOST) -> DataFrame:
    """documents -> doc_id, fingerprint, component_id."""
    rows = materialise(grouped(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"], most), "simhash-roots")
    # stored, so that a hot group of the join can be split
    least = materialise(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return rows.join(least, "root").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, whole: of each group the one with the smallest doc_id, the first if repeated.

    Rows are read twice, so their numbers are written with them, as a scan may be split anew.
    """
    numbered = materialise(docs.withColumn("_simhash_row", F.monotonically_increasing_id()), "simhash-docs")
    rows = materialise(grouped(numbered.select("doc_id", "_simhash_row", "text"), ["doc_id", "_simhash_row"]), "simhash-roots")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_simhash_row"))
    kept = materialise(rows.groupBy("root").agg(F.min(order).getField("_simhash_row").alias("_kept")), "simhash-kept")
    gone = materialise(rows.join(kept, "root").where("_simhash_row <> _kept").select("_simhash_row"), "simhash-gone")
    return numbered.join(gone, "_simhash_row", "left_anti").select(*docs.columns)
