"""Language-model scores by a probabilistic suffix tree, beside a unigram base.

Method: the tree predicts a text symbol by symbol. Words seen `SYMBOL_LEAST` times in training are symbols of
their own; other words share the symbol of their ending (three bytes if that ending is frequent, else two, else
one symbol for all), within which they have the proportions of the unigram base. The contexts of
a symbol are the last 0 to `depth` symbols of its text. A context is a state if it occurs `CONTEXT_LEAST` times
and its next-symbol distribution diverges from that of its longest proper suffix by more than
its parameters cost; the suffixes of a state are states. Distributions are smoothed towards the
suffix state's (Witten-Bell). A symbol is scored in the state of the longest suffix of what precedes it.

All counts are sums over all training texts, and nothing is left out for its share of them. Texts are cut into blocks
once, a row each, with the block's own list of words. Blocks ask shards, one row for each block and shard: first for the
counts of their words, dealt by word, then in a round for each depth for those of their different (context, next symbol)
pairs, dealt by context. A shard adds up what all blocks have and answers in the order asked. A context that occurs
often is dealt over several shards by its next symbols; blocks add up what those say of it. So the tree grows with the
texts, and nobody holds more than a block or a shard of it.

Defined results: null or empty text is the end token alone; rows without doc_id are not learned
from (held_out true); repeated rows are learned from and scored each; with nothing to learn from
the scores are those of the base; other columns are not looked at.
"""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fold, text_bytes
from shelfwise.session import bucketed, materialise

END = b""
START_SYMBOL, END_SYMBOL, OTHER_SYMBOL = 0, 1, 2
SYMBOL_BITS = 16  # of the tree in memory
DEPTH = 2
# Occurrences in training: of a word with a symbol of its own, of a context that may be a state.
SYMBOL_LEAST, CONTEXT_LEAST = 5, 2
# Of the tokens of all other words.
ENDING_SHARE = 2e-4
WORD_SHARE = 1e-6
# Tokens of a block (a longer text is a block of its own), and of all blocks for each shard; words of all blocks for each.
BLOCK = 1_300_000
SHARD = 2_000_000
SHARD_WORDS = 500_000
# A context is dealt over one more shard for each so many occurrences.
HOT = 500_000
# Sums of logarithms travel as whole numbers of this fraction: fewer bytes, and the same sum in any order.
UNIT = 2.0 ** -16


class Symbols:
    """The symbol of each word."""

    def __init__(self, words: list[bytes], endings: list[bytes]):
        names = sorted(words), sorted(endings)
        self.words = {w: OTHER_SYMBOL + 1 + i for i, w in enumerate(names[0])} | {END: END_SYMBOL}
        self.endings = {e: OTHER_SYMBOL + 1 + len(names[0]) + i for i, e in enumerate(names[1])}
        self.size = OTHER_SYMBOL + 1 + len(names[0]) + len(names[1])

    def of(self, word: bytes) -> int:
        found = self.words.get(word)
        if found is None:
            found = self.endings.get(word[-3:]) or self.endings.get(word[-2:]) or OTHER_SYMBOL
        return found


def find_symbols(tails: DataFrame, tokens: int) -> tuple[Symbols, np.ndarray, np.ndarray]:
    """tails(tail, n, mass): of the `tokens` tokens of words without a symbol of their own, by the last three bytes ->
    symbols of their frequent endings, and n and mass of each symbol."""
    endings = None
    for size in (3, 2):
        tail = tails.where(F.octet_length("tail") >= size).select(F.expr(f"substring(tail, -{size}, {size})").alias("tail"), "n")
        common = tail.groupBy("tail").agg(F.sum("n").alias("n")).where(F.col("n") >= ENDING_SHARE * tokens).select("tail")
        endings = common if endings is None else endings.union(common)
    symbols = Symbols([], [bytes(r["tail"]) for r in endings.collect()])

    def of_tails(batches):
        for batch in batches:
            ids = np.array([symbols.of(t) for t in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column(1), batch.column(2)], ["symbol", "n", "mass"])

    n, mass = np.zeros(symbols.size, np.int64), np.ones(symbols.size, np.int64)  # 1 for unknown words
    sums = tails.mapInArrow(of_tails, "symbol long, n long, mass long").groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))
    for r in sums.collect():  # one per ending
        n[r["symbol"]], mass[r["symbol"]] = r["n"], r["mass"]
    return symbols, n, mass


class Known(dict):
    """Symbols by word; those not met before are looked up once."""

    def __init__(self, symbols: Symbols):
        self.symbols = symbols

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.symbols.of(word)
        return found


class Logs(dict):
    """log10 probabilities by word; not a number for others."""

    def __missing__(self, word: bytes) -> float:
        return math.nan


def in_words(texts: list[bytes | None]) -> list[list[bytes]]:
    return [text_bytes(t) + [END] for t in texts]


def in_symbols(words: list[list[bytes]], ids: Known) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each text with its start before and its end, and the place in the text."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    begins = np.cumsum(lengths) - lengths
    out = np.full(int(lengths.sum()), START_SYMBOL, np.int64)
    place = np.arange(len(out)) - np.repeat(begins, lengths)
    out[place > 0] = np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), np.int64)
    return out, place


def grams_at(symbols: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with `depth` symbols of their text before them, and those symbols as a number."""
    at = np.flatnonzero(place >= max(depth, 1))
    context = np.zeros(len(at), np.int64)
    for back in range(depth, 0, -1):
        context = context << SYMBOL_BITS | symbols[at - back]
    return at, context


def find(values: np.ndarray, sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value, and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return at, sorted_values[at] == values


class State:
    """Contexts of one length that are states: what they are, their suffix's row among the states
    one shorter, and sparse log10 distributions: (row, symbol) -> value, else `rest` + the suffix's."""

    def __init__(self, contexts: np.ndarray, parent: np.ndarray, keys: np.ndarray, logs: np.ndarray, rest: np.ndarray):
        self.contexts, self.parent, self.keys, self.logs, self.rest = contexts, parent, keys, logs, rest


class Tree:
    """The tree in memory, for few symbols: what the rounds over blocks and shards are held against."""

    def __init__(self, root: np.ndarray):
        self.root, self.levels = root, []

    def log(self, depth: int, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol in the state (depth, row)."""
        if depth == 0:
            return self.root[symbol]
        level = self.levels[depth - 1]
        at, there = find(row << SYMBOL_BITS | symbol, level.keys)
        out = np.empty(len(row))
        out[there] = level.logs[at[there]]
        if not there.all():
            row, symbol = row[~there], symbol[~there]
            out[~there] = level.rest[row] + self.log(depth - 1, level.parent[row], symbol)
        return out

    def add_level(self, contexts: np.ndarray, total: np.ndarray, kinds: np.ndarray, row: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> None:
        """Contexts with their counts (total, different next symbols), and the frequent (row, symbol)
        counts; those that pass the test become states. Contexts whose suffix is none are left out."""
        depth = len(self.levels) + 1
        if depth == 1:
            parent, valid = np.zeros(len(contexts), np.int64), np.ones(len(contexts), bool)
        else:
            parent, valid = find(contexts & ((1 << SYMBOL_BITS * (depth - 1)) - 1), self.levels[-1].contexts)
        order = np.argsort(row << SYMBOL_BITS | symbol)
        row, symbol, n = row[order], symbol[order], n[order].astype(float)
        above = 10 ** self.log(depth - 1, parent[row], symbol)
        own = (n + kinds[row] * above) / (total[row] + kinds[row])
        size = len(contexts)
        left = np.maximum(1 - np.bincount(row, own, size), 1e-12)
        left_above = np.maximum(1 - np.bincount(row, above, size), 1e-12)
        plain = n / total[row]
        gain = np.bincount(row, n * np.log(plain / above), size)
        other = np.maximum(total - np.bincount(row, n, size), 0)
        gain = gain + np.where(other > 0, other * np.log(np.maximum(other, 1) / total / left_above), 0)
        kept = valid & (gain > 0.5 * kinds * np.log(total + 1))
        place = np.cumsum(kept) - 1
        use = kept[row]
        self.levels.append(State(
            contexts[kept], parent[kept], place[row[use]] << SYMBOL_BITS | symbol[use], np.log10(own[use]),
            np.log10(left / left_above)[kept]))

    def states(self) -> int:
        return 1 + sum(len(level.contexts) for level in self.levels)

    def lifts(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """For each position log10 of its probability in its state over that in the root."""
        out, waiting = np.zeros(len(symbols)), place > 0
        for depth in range(len(self.levels), 0, -1):
            at, context = grams_at(symbols, np.where(waiting, place, -1), depth)
            row, there = find(context, self.levels[depth - 1].contexts)
            at, row = at[there], row[there]
            out[at] = self.log(depth, row, symbols[at]) - self.root[symbols[at]]
            waiting[at] = False
        return out


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def loosened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers compressed as bytes, all first bytes before all second ones: the high bytes of small numbers go."""
    values = np.ascontiguousarray(values, kind)
    return squeezed(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(loosened(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def told_by(answers: pa.Table, name: str, kind: str) -> np.ndarray:
    """What all shards say, as asked: one shard after the other."""
    return np.concatenate([unpacked(x, kind) for x in answers[name].to_pylist()] or [np.empty(0, kind)])


CUT_DDL = "block long, doc_id array<long>, held array<boolean>, size array<int>, kinds long, word binary, hash binary, n binary, stream binary"
CUT = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())),
    ("kinds", pa.int64()), ("word", pa.binary()), ("hash", pa.binary()), ("n", pa.binary()), ("stream", pa.binary())])


def cut(most: int):
    """Texts -> blocks: the different words by their hash, how often each is there for training, and the tokens as places of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        doc_ids, held, texts, size = [], [], [], 0

        def block():
            words, lengths = list(ids), [len(t) for t in texts]
            hashes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            stream = place[np.concatenate(texts)]
            n = np.bincount(stream[np.repeat(~np.array(held), lengths)], minlength=len(words))
            spelled = squeezed(b" ".join([words[i] for i in order.tolist()]))  # no word has a blank
            columns = [
                random.getrandbits(63), doc_ids, held, lengths, len(words), spelled, packed(hashes[order], "<u4"), packed(n, "<i8"), packed(stream, "<i4")]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, CUT)], schema=CUT)

        for batch in batches:
            for text, doc_id, out in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text_bytes(text) + [END]
                if texts and size + len(words) > most:
                    yield block()
                    doc_ids, held, texts, size = [], [], [], 0
                    ids.clear()
                doc_ids.append(doc_id)
                held.append(out)
                texts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
                size += len(words)
        if texts:
            yield block()

    return run


WORDS_DDL = "shard int, block long, word binary, n binary"
WORDS = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("word", pa.binary()), ("n", pa.binary())])
TOLD_DDL = "shard int, block long, n binary, number binary, tail array<binary>, tail_n array<long>, tail_mass array<long>, tokens long, kinds long, ends long"
TOLD = pa.schema([
    ("shard", pa.int32()), ("block", pa.int64()), ("n", pa.binary()), ("number", pa.binary()), ("tail", pa.list_(pa.binary())),
    ("tail_n", pa.list_(pa.int64())), ("tail_mass", pa.list_(pa.int64())), ("tokens", pa.int64()), ("kinds", pa.int64()), ("ends", pa.int64())])


def ask_words(shards: int):
    """Blocks (block, word, hash, n) -> their words for each shard, which are those of a range of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, hashes, n in zip(*(column.to_pylist() for column in batch.columns)):
                words, n = loosened(words).split(b" "), unpacked(n, "<i8")
                there, begins = np.unique(unpacked(hashes, "<u4").astype(np.int64) * shards >> 32, return_index=True)
                cuts = [*begins.tolist(), len(words)]
                columns = [
                    there, np.full(len(there), block), [squeezed(b" ".join(words[low:high])) for low, high in zip(cuts, cuts[1:])],
                    [packed(n[low:high], "<i8") for low, high in zip(cuts, cuts[1:])]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WORDS)], schema=WORDS)

    return run


def count_words(shards: int):
    """What blocks ask a shard -> in the order asked how often the words are there, and the numbers of those with symbols of their own,
    frequent words first; in a row for no block, sums over the shard's words and over the endings of the others."""
    def run(asks: pa.Table) -> pa.Table:
        shard = asks["shard"][0].as_py()
        lists = [loosened(x).split(b" ") for x in asks["word"].to_pylist()]
        sizes = [len(x) for x in lists]
        found = pa.array([w for words in lists for w in words], pa.binary()).dictionary_encode()
        del lists
        of, names = found.indices.to_numpy(), found.dictionary.to_pylist()
        n = np.bincount(of, told_by(asks, "n", "<i8"), len(names)).astype(np.int64)
        end = np.array([w == END for w in names])
        own = np.flatnonzero((n >= SYMBOL_LEAST) & ~end)
        order = sorted(own.tolist(), key=lambda i: (-n[i], names[i]))
        number = np.full(len(names), -1)
        number[order] = np.arange(len(order)) * shards + shard
        cuts = np.cumsum(sizes)[:-1]
        rows = asks.num_rows
        answers = [
            np.full(rows, shard), asks["block"].to_numpy(), [packed(x, "<i8") for x in np.split(n[of], cuts)],
            [packed(x, "<i8") for x in np.split(number[of], cuts)], *[[None] * rows] * 6]
        tails: dict[bytes, list[int]] = {}
        for i in np.flatnonzero((n > 0) & (n < SYMBOL_LEAST) & ~end).tolist():
            sums = tails.setdefault(names[i][-3:], [0, 0])
            sums[0] += int(n[i])
            sums[1] += int(n[i]) + 1
        summary = [shard, None, None, None, list(tails), [x[0] for x in tails.values()], [x[1] for x in tails.values()], n.sum(), (n > 0).sum(), n[end].sum()]
        columns = [pa.concat_arrays([pa.array(c, f.type), pa.array([x], f.type)]) for c, x, f in zip(answers, summary, TOLD)]
        return pa.Table.from_arrays(columns, schema=TOLD)

    return run


STREAMS_DDL = (
    "block long, doc_id array<long>, held array<boolean>, size array<int>, known array<int>, base array<double>, "
    "symbol binary, total binary, stream binary")
STREAMS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())),
    ("known", pa.list_(pa.int32())), ("base", pa.list_(pa.float64())), ("symbol", pa.binary()), ("total", pa.binary()),
    ("stream", pa.binary())])


def sums_of(values: np.ndarray, sizes: np.ndarray) -> list[float]:
    """Of the consecutive values of each text."""
    ends = np.cumsum(sizes).tolist()
    values = values.tolist()
    return [math.fsum(values[low:high]) for low, high in zip([0, *ends], ends)]


def to_symbols(classes: Symbols, totals: np.ndarray, denominator: float, shards: int):
    """A block and the counts of its words -> the block in symbols, and the base of its texts. Words of their own follow the classes."""
    def run(cuts: pa.Table, told: pa.Table) -> pa.Table:
        if not cuts.num_rows:
            return STREAMS.empty_table()
        row = {name: cuts.column(name)[0] for name in cuts.column_names}
        told = told.sort_by("shard")
        n, symbol = told_by(told, "n", "<i8"), told_by(told, "number", "<i8")
        symbol[symbol >= 0] += classes.size
        words = pa.array(loosened(row["word"].as_py()).split(b" "), pa.binary())
        rare = np.flatnonzero(symbol < 0)
        tails = pc.binary_slice(words.take(pa.array(rare)), -3).dictionary_encode()
        of_tails = np.array([classes.of(t) for t in tails.dictionary.to_pylist()], np.int64)
        if len(rare):
            symbol[rare] = of_tails[tails.indices.to_numpy()]
        stream, size, held = unpacked(row["stream"].as_py(), "<i4"), row["size"].values.to_numpy(), row["held"].values
        base = sums_of(np.log10((n + 1) / denominator)[stream], size)
        seen = np.add.reduceat((n > 0)[stream].astype(np.int32), np.cumsum(size) - size)
        symbols, to = np.unique(np.r_[START_SYMBOL, symbol], return_inverse=True)
        of_own = np.zeros(len(symbols), np.int64)
        of_own[to[1:]] = n
        total = np.where(symbols < classes.size, totals[np.minimum(symbols, classes.size - 1)], of_own)
        columns = [
            row["block"].as_py(), row["doc_id"].values, held, size, seen, base, packed(np.diff(symbols, prepend=0), "<i8"),
            packed(total, "<i8"), packed(to[1:][stream], "<i4")]
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(columns, STREAMS)], schema=STREAMS)

    return run


ASKS_DDL = "shard int, block long, context binary, size binary, symbol binary, n binary, above binary"
ASKS = pa.schema([("shard", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("context", "size", "symbol", "n", "above")])
ANSWERS_DDL = "depth int, shard int, block long, kinds binary, gain binary, n binary"
ANSWERS = pa.schema([("depth", pa.int32()), ("shard", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("kinds", "gain", "n")])


class Grams:
    """The different grams of a block at one depth, from 0 on: a gram is a symbol and the `depth` symbols before it."""

    def __init__(self, row: dict, masses: np.ndarray, denominator: float, shards: int):
        self.block, self.shards = row["block"].as_py(), shards
        self.size, held = row["size"].values.to_numpy(), np.array(row["held"].values)
        self.symbols = np.cumsum(unpacked(row["symbol"].as_py(), "<i8"))
        lengths = self.size + 1
        begins = np.cumsum(lengths) - lengths
        self.place = (np.arange(int(lengths.sum())) - np.repeat(begins, lengths)).astype(np.int32)
        self.stream = np.zeros(len(self.place), np.int32)  # the start is the least symbol
        self.stream[self.place > 0] = unpacked(row["stream"].as_py(), "<i4")
        self.trained = np.repeat(~held, lengths)
        self.depth, self.gram = 0, self.stream  # at each place with so many symbols before it
        self.context = self.symbols  # each gram as a number, and how often it is there in all texts for training
        self.n = unpacked(row["total"].as_py(), "<i8")
        with np.errstate(divide="ignore"):
            self.root = np.log10(np.where(
                self.symbols < len(masses), masses[np.minimum(self.symbols, len(masses) - 1)], self.n + 1) / denominator)
        self.log = self.root  # of its last symbol, in its state
        self.state = np.ones(len(self.n), bool)  # whether the symbols before the last are one
        self.lift = np.zeros(len(self.place))

    def longer(self, last: bool) -> None:
        """Grams of one more symbol, and in which order they are asked for."""
        self.depth += 1
        self.at = np.flatnonzero(self.place >= self.depth).astype(np.int32)
        pairs, of = np.unique(self.gram[self.at - 1] * np.int64(len(self.symbols)) + self.stream[self.at], return_inverse=True)
        self.of = of.astype(np.int32)
        del of
        self.before = (pairs // len(self.symbols)).astype(np.int32)
        self.last = (pairs % len(self.symbols)).astype(np.int32)
        self.suffix = np.empty(len(pairs), np.int32)
        self.suffix[self.of] = self.gram[self.at]
        del pairs
        self.above = self.log[self.suffix]
        self.asked = self.n[self.before] >= CONTEXT_LEAST
        if last:  # else a longer context may be made of it
            self.asked &= self.state[self.suffix]
        entry = np.flatnonzero(self.asked).astype(np.int32)
        before = self.before[entry]
        part = self.symbols[self.last[entry]] % (self.n[before] // HOT + 1)
        # Contexts in several shards are asked for in each, if only with no symbol.
        hot = np.unique(before[self.n[before] >= HOT])
        times = self.n[hot] // HOT + 1
        if len(hot):
            entry = np.r_[entry, np.full(int(times.sum()), -1, np.int32)]
            part = np.r_[part, np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
            before = np.r_[before, np.repeat(hot, times)]
        shard = self.shard(self.context[before], part).astype(np.int32)
        order = np.lexsort((before, shard)) if len(hot) else np.argsort(shard, kind="stable")
        self.entry, before, self.of_shard = entry[order], before[order], shard[order]
        change = (before[1:] != before[:-1]) | (self.of_shard[1:] != self.of_shard[:-1])
        self.begins = np.flatnonzero(np.r_[True, change]) if len(before) else np.empty(0, np.int64)
        self.holder = before[self.begins]  # the context that each run of entries is of

    def shard(self, key: np.ndarray, part: np.ndarray) -> np.ndarray:
        mixed = (key.astype(np.uint64) + part.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)

    def asks(self) -> pa.Table:
        """A row for each shard."""
        real = self.entry >= 0
        at = self.entry[real]
        symbol, n, spent = np.full(len(real), -1), np.zeros(len(real), np.int64), np.zeros(len(real))
        symbol[real] = self.symbols[self.last[at]]
        n[real] = np.bincount(self.of[self.trained[self.at]], minlength=len(self.before))[at]
        spent[real] = np.where(n[real] > 0, n[real] * self.above[at], 0.0) * -math.log(10)
        if len(real):
            spent = np.rint(np.add.reduceat(spent, self.begins) / UNIT)
        shard = self.of_shard[self.begins]
        shards = np.unique(shard)
        runs, entries = (np.r_[np.searchsorted(x, shards), len(x)] for x in (shard, self.of_shard))
        parts = lambda values, cuts, kind: [packed(values[low:high], kind) for low, high in zip(cuts, cuts[1:])]
        columns = [
            shards, np.full(len(shards), self.block), parts(self.context[self.holder], runs, "<i8"),
            parts(np.diff(np.r_[self.begins, len(real)]), runs, "<i4"), parts(symbol, entries, "<i8"), parts(n, entries, "<i8"), parts(spent, runs, "<i8")]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ASKS)], schema=ASKS)

    def told(self, answers: pa.Table) -> None:
        """The answers make contexts states, and give the probabilities in them."""
        answers = answers.filter(pc.equal(answers["depth"], self.depth)).sort_by("shard")
        kinds = np.bincount(self.holder, told_by(answers, "kinds", "<i8"), len(self.n))
        gain = np.bincount(self.holder, told_by(answers, "gain", "<i8"), len(self.n)) * UNIT
        total = np.maximum(self.n, 1).astype(float)
        diverges = gain - total * np.log(total) > 0.5 * kinds * np.log(total + 1)
        real, before = self.entry >= 0, self.before
        n = np.zeros(len(before), np.int64)
        n[self.entry[real]] = told_by(answers, "n", "<i8")[real]
        self.state = self.asked & diverges[before] & self.state[self.suffix]
        at = np.flatnonzero(self.state)
        self.log = self.above
        self.log[at] = np.log10((n[at] + kinds[before[at]] * 10 ** self.above[at]) / (total + kinds)[before[at]])
        if self.depth == 1:  # two symbols side by side; longer ones are hashed
            self.context = self.context[before] << 32 | self.symbols[self.last]
        else:
            mixed = self.context[before].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self.context = ((mixed ^ (mixed >> np.uint64(29))) + self.symbols[self.last].astype(np.uint64)).astype(np.int64)
        self.n = n
        self.lift[self.at] = (self.log - self.root[self.last])[self.of]
        self.gram = np.full(len(self.stream), -1, np.int32)
        self.gram[self.at] = self.of

    def lifts(self) -> list[float]:
        """Of each text, log10 of its probability over that of its symbols in the root."""
        return sums_of(self.lift[self.place > 0], self.size)


def reached(streams: pa.Table, answers: pa.Table, base: tuple[np.ndarray, float], shards: int, depth: int, told: int) -> Grams:
    """The grams of a block after so many of the `depth` rounds; base: n + 1 of the classes, and of all words."""
    grams = Grams({name: streams.column(name)[0] for name in streams.column_names}, *base, shards)
    for length in range(1, told + 1):
        grams.longer(length == depth)
        grams.told(answers)
    return grams


def count_grams(depth: int):
    """What blocks ask a shard -> different symbols after each context, n log n over them less n log of what the suffix
    says, and the count of each (context, symbol)."""
    def run(asks: pa.Table) -> pa.Table:
        asks = asks.sort_by("block")
        given = {c: [unpacked(x, k) for x in asks[c].to_pylist()] for c, k in zip(ASKS.names[2:], ("<i8", "<i4", "<i8", "<i8", "<i8"))}
        whole = {c: np.concatenate(x) for c, x in given.items()}
        names, which = np.unique(whole["context"], return_inverse=True)
        grams, to = np.unique(np.repeat(which, whole["size"]) << 32 | (whole["symbol"] + 1), return_inverse=True)
        n = np.bincount(to, whole["n"], len(grams)).astype(np.int64)
        seen = n > 0
        kinds = np.bincount((grams >> 32)[seen], minlength=len(names))
        gain = np.rint(np.bincount((grams >> 32)[seen], n[seen] * np.log(n[seen]), len(names)) / UNIT) + np.bincount(which, whole["above"], len(names))
        parts = lambda values, name, kind: [
            packed(x, kind) for x in np.split(values, np.cumsum([len(x) for x in given[name]])[:-1])]
        rows = asks.num_rows
        columns = [
            np.full(rows, depth), asks["shard"].to_numpy(), asks["block"].to_numpy(), parts(kinds[which], "context", "<i8"),
            parts(gain[which], "context", "<i8"), parts(n[to], "symbol", "<i8")]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ANSWERS)], schema=ANSWERS)

    return run


def ask_grams(length: int, depth: int, base: tuple[np.ndarray, float], shards: int):
    """A block and its answers for shorter grams -> what it asks of those of a length."""
    def run(streams: pa.Table, answers: pa.Table) -> pa.Table:
        if not streams.num_rows:
            return ASKS.empty_table()
        grams = reached(streams, answers, base, shards, depth, length - 1)
        grams.longer(length == depth)
        return grams.asks()

    return run


def learn(streams: DataFrame, base: tuple[np.ndarray, float], depth: int, shards: int) -> DataFrame:
    """Blocks in symbols -> for each depth and block what the shards say of its grams."""
    answers = streams.sparkSession.createDataFrame([], ANSWERS_DDL)
    for length in range(1, depth + 1):
        asks = streams.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask_grams(length, depth, base, shards), ASKS_DDL)
        found = asks.groupBy("shard").applyInArrow(count_grams(length), ANSWERS_DDL)
        answers = answers.union(materialise(found, f"suffix-answers-{length}"))
    return answers


OUT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, parts: int = 7, held: int = 2, depth: int = DEPTH, word_share: float = WORD_SHARE) -> DataFrame:
    """documents -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `word_share` once told words to broadcast from those to join; all words meet their counts in shards now, so it changes nothing.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(fold("doc_id", parts) == held, F.lit(True))
    given = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long"), held_out.alias("held_out"))
    cuts = materialise(given.mapInArrow(cut(BLOCK), CUT_DDL), "suffix-blocks", wide=True)
    shards = max(1, math.ceil((cuts.agg(F.sum("kinds")).first()[0] or 0) / SHARD_WORDS))
    asked = cuts.select("block", "word", "hash", "n").mapInArrow(ask_words(shards), WORDS_DDL)
    told = materialise(asked.groupBy("shard").applyInArrow(count_words(shards), TOLD_DDL), "suffix-words")
    sums = told.where("block is null")
    tokens, kinds, ends = (x or 0 for x in sums.agg(F.sum("tokens"), F.sum("kinds"), F.sum("ends")).first())
    denominator = float(tokens + kinds + 1)
    tails = sums.select(F.explode(F.arrays_zip("tail", "tail_n", "tail_mass")).alias("t")).groupBy("t.tail").agg(
        F.sum("t.tail_n").alias("n"), F.sum("t.tail_mass").alias("mass"))
    classes, totals, masses = find_symbols(tails, tails.agg(F.sum("n")).first()[0] or 0)
    totals[[START_SYMBOL, END_SYMBOL]], masses[[START_SYMBOL, END_SYMBOL]] = ends, (0, ends + 1)
    answers = told.where("block is not null").select("shard", "block", "n", "number")
    streams = bucketed(
        cuts.drop("hash", "n").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(to_symbols(classes, totals, denominator, shards), STREAMS_DDL),
        "block", "suffix_streams", wide=True)
    shards = max(1, math.ceil(tokens / SHARD))
    rounds = depth if tokens else 0
    base = masses, denominator
    answers = learn(streams.drop("doc_id", "known", "base"), base, rounds, shards)

    def close(block: pa.Table, told: pa.Table) -> pa.Table:
        row = {name: block.column(name)[0].values for name in ("doc_id", "held", "size", "known", "base")}
        lifts = reached(block, told, base, shards, rounds, rounds).lifts()
        of_words = row["base"].to_numpy()
        columns = [row["doc_id"], row["held"], row["size"], row["known"], np.full(len(of_words), tokens), of_words, of_words + lifts]
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, OUT)], schema=OUT)

    out = ", ".join(f"{n} {k}" for n, k in zip(OUT.names, ("long", "boolean", "long", "long", "long", "double", "double")))
    return streams.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(close, out)
