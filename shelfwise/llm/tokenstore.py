"""Token ids in binary shards, with a minimal perfect hash index over the document keys.

Layout of a store (a folder that all executors reach):

- `*.ids`: raw ids of a run of documents in ascending doc_id order, 2 bytes each if the
  vocabulary fits, else 4, little-endian, nothing else;
- `*.keys`: per shard the documents' keys and the place of each document's first id;
- `*.mph`: per index part a minimal perfect hash of its keys. Slot k holds a 32-bit fingerprint
  of the key that belongs there, and shard, first id and number of ids;
- `manifest`, `index`: tables that name the files. A file counts only if named there, so
  what a lost or repeated task leaves behind is never read.

The hash: keys are hashed into a bit set; those that land alone stay, the others go to the next,
smaller set. A key's slot is the number of set bits before its own, so a lookup takes a few
hashes whatever the number of keys, and foreign keys are told by their fingerprint.

Defined results: null or empty text is the end id alone; a null doc_id comes first and is a key;
rows that repeat a doc_id are told apart by their occurrence, in text order; an empty table gives
an empty store; other columns are not looked at.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import rows_to_batch
from shelfwise.llm.encoding import encoder
from shelfwise.llm.ranges import bounds, parts_for, range_of
from shelfwise.session import scratch_path

END = b"\0\0\0\0"
# Keys of an index part, on average.
KEYS_IN_PART = 50_000
READ_AHEAD = 8 << 20
KEY = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("occurrence", "<u4"), ("first", "<u8"), ("n", "<u4")])
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("n", "<u4")])


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def save(uri: str, chunks) -> None:
    fs, path = opened(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)


def load(uri: str) -> bytes:
    fs, path = opened(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


# ---------------------------------------------------------------- the hash

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def scramble(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(known: np.ndarray, doc_id: np.ndarray, occurrence: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        start = scramble(np.full(len(doc_id), seed + 1, np.uint64) * GOLDEN)
        once = scramble(doc_id.astype(np.int64).view(np.uint64) + start)
        rest = (occurrence.astype(np.uint64) << np.uint64(1)) | known.astype(np.uint64)
        return scramble(once ^ scramble(rest * GOLDEN + start))


class PerfectHash:
    """Slots 0 .. n - 1 for n different keys (known, doc_id, occurrence)."""

    LEVELS = 64

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.before, total = sets, [], 0
        for bits in sets:
            ranks = np.cumsum(bits, dtype=np.int64) - bits + total
            self.before.append(ranks)
            total += int(bits.sum())

    @classmethod
    def build(cls, known, doc_id, occurrence, room: float = 2.0) -> PerfectHash:
        sets, left = [], np.arange(len(doc_id))
        for level in range(cls.LEVELS):
            if not len(left):
                return cls(sets)
            size = max(1, int(room * len(left)))
            at = (hashed(known[left], doc_id[left], occurrence[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sets.append(alone)
            left = left[~alone[at]]
        raise ValueError("keys of the index are not unique")

    def slots(self, known, doc_id, occurrence) -> np.ndarray:
        """-1 for a key that cannot be there."""
        found, open_ = np.full(len(doc_id), -1, np.int64), np.arange(len(doc_id))
        for level, bits in enumerate(self.sets):
            at = (hashed(known[open_], doc_id[open_], occurrence[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found[open_[hit]] = self.before[level][at[hit]]
            open_ = open_[~hit]
        return found

    def dump(self) -> bytes:
        head = np.array([len(self.sets), *map(len, self.sets)], "<u8").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.sets)

    @classmethod
    def parse(cls, data: bytes) -> tuple[PerfectHash, int]:
        levels = int(np.frombuffer(data, "<u8", 1)[0])
        sizes, at, sets = np.frombuffer(data, "<u8", levels, 8), 8 * (levels + 1), []
        for size in map(int, sizes):
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            sets.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(sets), at


FINGERPRINT_SEED = 1_000_003


def fingerprints(known, doc_id, occurrence) -> np.ndarray:
    return (hashed(known, doc_id, occurrence, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


def index_file(entries: np.ndarray, shards: np.ndarray) -> bytes:
    """entries: KEY rows of one index part, shards: the shard of each."""
    found = PerfectHash.build(entries["known"], entries["doc_id"], entries["occurrence"])
    slots = np.zeros(len(entries), SLOT)
    at = found.slots(entries["known"], entries["doc_id"], entries["occurrence"])
    slots["fingerprint"][at] = fingerprints(entries["known"], entries["doc_id"], entries["occurrence"])
    slots["shard"][at], slots["first"][at], slots["n"][at] = shards, entries["first"], entries["n"]
    return found.dump() + slots.tobytes()


class IndexPart:
    def __init__(self, data: bytes):
        self.hash, at = PerfectHash.parse(data)
        self.slots = np.frombuffer(data, SLOT, offset=at)

    def find(self, known, doc_id, occurrence) -> tuple[np.ndarray, np.ndarray]:
        """Slot rows, and whether the key is in the index (but for 1 in 2 ** 32 foreign keys)."""
        at = self.hash.slots(known, doc_id, occurrence)
        there = at >= 0
        rows = self.slots[np.where(there, at, 0)] if len(self.slots) else np.zeros(len(at), SLOT)
        return rows, there & (rows["fingerprint"] == fingerprints(known, doc_id, occurrence))


# ---------------------------------------------------------------- writing

MANIFEST = pa.schema([("shard", pa.int64()), ("ids", pa.string()), ("keys", pa.string()), ("docs", pa.int64()), ("n_ids", pa.int64())])
LOCATED = pa.schema([
    ("known", pa.bool_()), ("doc_id", pa.int64()), ("occurrence", pa.int64()), ("shard", pa.int64()),
    ("first", pa.int64()), ("n", pa.int64())])
LOCATED_DDL = "known boolean, doc_id long, occurrence long, shard long, first long, n long"


def write(docs: DataFrame, tokenizer: str, folder: str | None = None) -> TokenStore:
    """Write docs(doc_id, text) as a store; one range of ids per task and shard."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    width = 2 if len(encoder(tokenizer).four) <= 1 << 16 else 4

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name, keys, state = encoder(tokenizer).ids, f"{folder}/shards/{uuid.uuid4().hex}", [], [None, 0, 0]

        def run():
            last, occurrence = None, 0
            for batch in batches:
                for at, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    ids = encode(text) + END
                    occurrence = occurrence + 1 if state[1] and doc_id == last else 0
                    last, n = doc_id, len(ids) // 4
                    keys.append((doc_id is not None, doc_id or 0, occurrence, state[2], n))
                    state[0], state[1], state[2] = at, state[1] + 1, state[2] + n
                    yield ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()

        save(f"{name}.ids", run())
        save(f"{name}.keys", [np.array(keys, KEY).tobytes()])
        if keys:
            yield rows_to_batch([(state[0], f"{name}.ids", f"{name}.keys", state[1], state[2])], MANIFEST)

    thin = docs.select(F.col("doc_id").cast("long"), "text")
    parts = parts_for(thin)
    cuts = bounds(thin, "doc_id", parts)
    ordered = (
        thin.select(range_of("doc_id", cuts).alias("part"), "doc_id", "text")
        .repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    ordered.mapInArrow(shard, "shard long, ids string, keys string, docs long, n_ids long").write.parquet(f"{folder}/manifest")
    return index(spark, folder, width)


def keys_of(manifest: DataFrame) -> DataFrame:
    """All keys of a store, read from its files: known, doc_id, occurrence, shard, first, n."""
    def run(batches):
        for batch in batches:
            for shard, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = np.frombuffer(load(uri), KEY)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows["known"].astype(bool)), pa.array(rows["doc_id"], pa.int64()),
                    pa.array(rows["occurrence"].astype(np.int64)), pa.array(np.full(len(rows), shard, np.int64)),
                    pa.array(rows["first"].astype(np.int64)), pa.array(rows["n"].astype(np.int64))], schema=LOCATED)

    return manifest.select("shard", "keys").mapInArrow(run, LOCATED_DDL)


def index_part(parts: int):
    return F.pmod(F.xxhash64("known", "doc_id", "occurrence"), F.lit(parts)).cast("int")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows with the same first column, over all batches."""
    held, current = [], None
    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if held and part[low] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = part[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield current, pa.Table.from_batches(held)


def numpy_of(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def index(spark: SparkSession, folder: str, width: int) -> TokenStore:
    """Write the index parts of a store whose shards and manifest are there."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    docs = manifest.agg(F.sum("docs")).first()[0] or 0
    parts = max(1, -(-docs // KEYS_IN_PART))

    def build(batches):
        for part, table in grouped(batches):
            entries = np.zeros(table.num_rows, KEY)
            for name in KEY.names:
                entries[name] = numpy_of(table, name)
            uri = f"{folder}/index-parts/{uuid.uuid4().hex}.mph"
            save(uri, [index_file(entries, numpy_of(table, "shard"))])
            yield pa.RecordBatch.from_pydict({"part": [int(part)], "file": [uri]}, schema=pa.schema([("part", pa.int64()), ("file", pa.string())]))

    keyed = keys_of(manifest).withColumn("part", index_part(parts)).select("part", *LOCATED.names)
    (keyed.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
     .mapInArrow(build, "part long, file string").write.parquet(f"{folder}/index"))
    return TokenStore(spark, folder, width, parts)


# ---------------------------------------------------------------- reading


class Window:
    """Forward reads of a file through a buffer, so that near reads share a request."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        self.file, self.at, self.data = fs.open_input_file(path), 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.data):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(n, READ_AHEAD))
        return self.data[at - self.at:at - self.at + n]


FOUND = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


class TokenStore:
    def __init__(self, spark: SparkSession, folder: str, width: int, parts: int):
        self.spark, self.folder, self.width, self.parts = spark, folder, width, parts

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/manifest")

    def keys(self) -> DataFrame:
        return keys_of(self.manifest()).select("known", "doc_id", "occurrence")

    def locate(self, keys: DataFrame) -> DataFrame:
        """keys(known, doc_id, occurrence) -> the same with shard, first, n; foreign keys are left out."""
        files = {r["part"]: r["file"] for r in self.spark.read.parquet(f"{self.folder}/index").collect()}  # one per 50,000 keys
        shared = self.spark.sparkContext.broadcast(files)

        def run(batches):
            current, loaded = None, None
            for batch in batches:
                part = batch.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
                for low, high in zip(edges, edges[1:]):
                    if low == high or part[low] not in shared.value:
                        continue
                    if part[low] != current:
                        current, loaded = part[low], IndexPart(load(shared.value[int(part[low])]))
                    piece = batch.slice(low, high - low)
                    known, doc_id, occurrence = (piece.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
                    rows, there = loaded.find(known, doc_id, occurrence)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(known[there]), pa.array(doc_id[there]), pa.array(occurrence[there]),
                        *(pa.array(rows[name][there].astype(np.int64)) for name in ("shard", "first", "n"))], schema=LOCATED)

        keyed = keys.select("known", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("occurrence").cast("long"))
        return (
            keyed.select(index_part(self.parts).cast("long").alias("part"), "known", "doc_id", "occurrence")
            .repartition("part").sortWithinPartitions("part").mapInArrow(run, LOCATED_DDL))

    def read(self, keys: DataFrame, with_ids: bool = False) -> DataFrame:
        """Documents of keys(known, doc_id, occurrence), from the files: doc_id, start, n_tokens,
        ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit)."""
        shards = sorted((r["shard"], r["ids"], r["n_ids"]) for r in self.manifest().collect())  # one per task that wrote
        base, files = 0, {}
        for shard, uri, n in shards:
            files[shard] = (uri, base)
            base += n
        shared, width = self.spark.sparkContext.broadcast(files), self.width

        def run(batches):
            current, window, start = None, None, 0
            for batch in batches:
                rows = []
                for known, doc_id, _, shard, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if shard != current:
                        uri, start = shared.value[shard]
                        current, window = shard, Window(uri)
                    ids = window.read(first * width, n * width)
                    if width == 2:
                        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    rows.append((doc_id if known else None, start + first, n, zlib.crc32(ids), ids if with_ids else None))
                yield rows_to_batch(rows, FOUND)

        found = self.locate(keys).repartition("shard").sortWithinPartitions("shard", "first").mapInArrow(
            run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
        return found if with_ids else found.drop("ids")
