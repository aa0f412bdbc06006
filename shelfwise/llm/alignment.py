"""Two tokenizers' token sequences aligned by byte offsets, as Arrow tables.

Method: texts are gathered in blocks of bounded size. The id lists of both tokenizers are
flattened, with each token's document from the lists' parent indices; the tokens' bytes come from a
table by id, and a cumulative sum of their lengths, less what lay before the document, is the
offset where a token ends. A hash join on (document, end) finds the tokens of both that end together: the
links, which also cut the text into groups. Counts of linked id pairs are grouped within a block, and summed
by Spark over all blocks.

A block is one row with its own list of different pairs, so the corpus-wide counts come back as a
row for each block and pair, not for each link; the links are places in that list. The block is
then closed with the counts beside it, and sums over each document's links are grouped again.

Defined results: null and empty texts, and texts whose joined token bytes differ from a space and the text,
have no tokens: zeros and an empty string; special tokens' strings are plain text; repeated rows and
null ids are rows of their own; a very long text is a block of its own; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import BYTES_SETTING
from shelfwise.llm.encoding import Encoder, byte_letters
from shelfwise.session import materialise

# Bytes of text of a block; a longer text is a block of its own.
BLOCK = 500_000
# Pre-tokens whose ids a worker keeps.
MOST_PIECES = 150_000
# Of block rows handed to Python at once.
BATCH_BYTES = "4m"
# A pair in one number: first id above, second below.
HALF = 32
SPACE = "▁"


class Tokenizers:
    """Both tokenizers, with the bytes of every id and the id as text for the groups' string."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.first, self.second = Encoder(byte_path, MOST_PIECES), sentencepiece.SentencePieceProcessor(model_file=piece_path)
        place = {letter: value for value, letter in enumerate(byte_letters())}
        with open(byte_path, encoding="utf-8") as f:
            added = {t["id"]: t["content"].encode() for t in json.load(f).get("added_tokens", [])}
        size = self.first.tokenizer.get_vocab_size()
        self.bytes_a = pa.array(
            [added[i] if i in added else bytes(map(place.__getitem__, self.first.tokenizer.id_to_token(i))) for i in range(size)], pa.large_binary())
        pieces = [self.second.id_to_piece(i) for i in range(self.second.vocab_size())]
        self.bytes_b = pa.array(
            [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)], pa.large_binary())
        # Ids as text with what follows them: within a group, at the end of its first or second half.
        self.halves = 2 * size
        self.labels = pa.array(
            [f"{i}{mark}" for i in range(size) for mark in ",|"] + [f"{i}{mark}" for i in range(len(pieces)) for mark in ",;"], pa.large_string())

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        a = [np.frombuffer(self.first.ids(" " + t), "<u4") for t in texts]
        b = self.second.encode(texts, num_threads=1)
        sizes = lambda lists: pa.array(np.r_[0, np.cumsum([len(x) for x in lists])], pa.int64())
        flat = np.fromiter((i for ids in b for i in ids), np.int64, sum(map(len, b)))
        return (pa.LargeListArray.from_arrays(sizes(a), pa.array(np.concatenate(a).astype(np.int64))),
                pa.LargeListArray.from_arrays(sizes(b), pa.array(flat)))


@lru_cache(1)
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    """One per worker process."""
    return Tokenizers(byte_path, piece_path)


def spelled(lists: pa.LargeListArray, table: pa.Array) -> tuple[memoryview, np.ndarray]:
    """Joined bytes of all lists, and where each list begins in them, with the end of the last."""
    found = pc.take(table, pc.list_flatten(lists))
    starts = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)
    return memoryview(found.buffers()[2] or b"").cast("B"), starts[lists.offsets.to_numpy()]


def tokens(lists: pa.LargeListArray, table: pa.Array, name: str) -> pa.Table:
    """A row per token: doc, end (byte offset in its document), and the token's place and id."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ends = pc.cumulative_sum(pc.binary_length(pc.take(table, ids)))
    before = np.r_[0, ends.to_numpy()][lists.offsets.to_numpy()[:-1]]
    return pa.table({"doc": doc, "end": pc.subtract(ends, pc.take(pa.array(before), doc)), f"place_{name}": np.arange(len(ids)), name: ids})


def group_strings(a: pa.Table, b: pa.Table, links: pa.Table, docs: int, tools: Tokenizers) -> list[str]:
    """SHA-256 of each document's groups, ids in decimal."""
    last_a, last_b = (np.zeros(t.num_rows, np.int64) for t in (a, b))
    ends_a, ends_b = links["place_a"].to_numpy(), links["place_b"].to_numpy()
    last_a[ends_a] = last_b[ends_b] = 1
    # Tokens of the second in groups before a token's own, and the other way about.
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    place_a = np.arange(len(last_a)) + np.r_[0, ends_b + 1][group_a]
    place_b = np.arange(len(last_b)) + (ends_a + 1)[group_b]
    label = np.empty(len(last_a) + len(last_b), np.int64)
    label[place_a] = a["a"].to_numpy() * 2 + last_a
    label[place_b] = tools.halves + b["b"].to_numpy() * 2 + last_b
    written = pc.take(tools.labels, pa.array(label))
    starts = np.frombuffer(written.buffers()[1], np.int64, len(written) + 1, written.offset * 8)
    text = memoryview(written.buffers()[2] or b"")
    counts = np.bincount(a["doc"].to_numpy(), minlength=docs) + np.bincount(b["doc"].to_numpy(), minlength=docs)
    cuts = starts[np.r_[0, np.cumsum(counts)]].tolist()
    return [hashlib.sha256(text[low:high - 1]).hexdigest() for low, high in zip(cuts, cuts[1:])]


BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())),
    ("n", pa.list_(pa.int64())), ("links", pa.list_(pa.int32()))])
BLOCKS_DDL = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "pairs array<long>, n array<long>, links array<int>")


def align(ids: list[int | None], texts: list[str | None], tools: Tokenizers) -> pa.RecordBatch:
    """One block row. Its links stand in order of document and end."""
    n_a, n_b, n_groups = (np.zeros(len(texts), np.int64) for _ in range(3))
    shas = [""] * len(texts)
    pairs, counts, places = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    at = [i for i, t in enumerate(texts) if t]
    if at:
        a, b = tools.encode([texts[i] for i in at])
        given = [(" " + texts[i]).encode() for i in at]
        whole = [spelled(lists, table) for lists, table in ((a, tools.bytes_a), (b, tools.bytes_b))]
        same = [all(text[starts[k]:starts[k + 1]] == g for text, starts in whole) for k, g in enumerate(given)]
        at, kept = [i for i, s in zip(at, same) if s], pa.array(np.flatnonzero(same))
        if len(at) < len(same):
            a, b = a.take(kept), b.take(kept)
    if at:
        a, b = tokens(a, tools.bytes_a, "a"), tokens(b, tools.bytes_b, "b")
        links = a.join(b, ["doc", "end"], join_type="inner", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])
        for counted, out in ((a, n_a), (b, n_b), (links, n_groups)):
            out[at] = np.bincount(counted["doc"].to_numpy(), minlength=len(at))
        for i, sha in zip(at, group_strings(a, b, links, len(at), tools)):
            shas[i] = sha
        pair = pc.add(pc.shift_left(links["a"], HALF), links["b"])
        partial = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        pairs, counts = partial["pair"].to_numpy(), partial["count_all"].to_numpy()
        places = np.searchsorted(pairs, pair.to_numpy()).astype(np.int32)
    columns = [random.getrandbits(63), ids, n_a, n_b, n_groups, shas, pairs, counts, places]
    return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, BLOCKS)], schema=BLOCKS)


def align_blocks(byte_path: str, piece_path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, ids, texts, size = tokenizers(byte_path, piece_path), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and size + len(text or "") > block:
                    yield align(ids, texts, tools)
                    pa.default_memory_pool().release_unused()
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
        if ids:
            yield align(ids, texts, tools)

    return run


OUT = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])


def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows with the corpus-wide count of each of their pairs, and whether it is its second id's best."""
    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(name)[row].values for name in batch.schema.names if name != "block"}
            found = np.argsort(cell["found"].to_numpy())
            total, best = (pa.array(cell[name].to_numpy(zero_copy_only=False)[found].astype(np.int64)) for name in ("total", "best"))
            n_links = cell["n_groups"].to_numpy()
            doc = np.repeat(np.arange(len(n_links)), n_links)
            sums = pa.table({"doc": doc, "total": pc.take(total, cell["links"]), "best": pc.take(best, cell["links"])}).group_by(
                "doc", use_threads=False).aggregate([("total", "sum"), ("best", "sum")])
            n_best, count_sum = np.zeros(len(n_links), np.int64), np.zeros(len(n_links), np.int64)
            n_best[sums["doc"].to_numpy()], count_sum[sums["doc"].to_numpy()] = sums["best_sum"].to_numpy(), sums["total_sum"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [cell["doc_id"], cell["n_a"], cell["n_b"], cell["n_groups"], pa.array(n_links), pa.array(n_best), pa.array(count_sum), cell["groups_sha256"]], schema=OUT)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, total (links that hold it), best (1 if no pair with its second id has more)."""
    counts = materialise(
        blocks.select(F.explode(F.arrays_zip("pairs", "n")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.n").alias("total")), "align-counts")
    second = F.col("pair").bitwiseAND((1 << HALF) - 1)
    most = counts.groupBy(second.alias("second")).agg(F.max("total").alias("most"))
    return materialise(
        counts.withColumn("second", second).join(most, "second")
        .select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best")), "align-best")


def compare(docs: DataFrame, byte_path: str, piece_path: str, block: int = BLOCK) -> DataFrame:
    """documents -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs.sparkSession.conf.set(BYTES_SETTING, BATCH_BYTES)
    blocks = materialise(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align_blocks(byte_path, piece_path, block), BLOCKS_DDL), "align-blocks", wide=True)
    wanted = blocks.select("block", F.explode("pairs").alias("pair"))
    # A block gets back as many rows as it has different pairs.
    told = wanted.join(pair_counts(blocks), "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "total", "best")).alias("told"))
    told = materialise(told.select(
        "block", F.col("told.pair").alias("found"), F.col("told.total").alias("total"), F.col("told.best").alias("best")), "align-told", wide=True)
    none = F.array().cast("array<long>")
    joined = blocks.join(told, "block", "left").select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", *[F.coalesce(n, none).alias(n) for n in ("found", "total", "best")])
    return joined.mapInArrow(close, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in OUT))
