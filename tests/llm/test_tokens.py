import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from helpers import ROWS, awkward, empty
from tokenizers import Tokenizer

from shelfwise.llm import packing, tokencount, tokenstore
from shelfwise.llm.encoding import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TRICKY = [
    "a  b   c", " lead", "trail ", "\n\nx\n y \n", "don't I'll we've", "Été À LA ÿ ß ŒUVRE", "étude ́", "a b c",
    "tab\tand\r\nline", "\x1cx\x1dy", "日本語 текст", "1234 5,6", "foo.\nBar baz!? ...", "<|endoftext|> <|startoftext|>", "İstanbul",
    "µ ª º × ÷", "a\x00b", " ", "\n", "x \n", "under_score—dash", "the​zero",
]


def plain(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_gives_the_tokenizers_ids(path, docs):
    texts = TRICKY + [r.text for r in docs.limit(100).collect() if r.text]
    encoder = Encoder(path, most=500)
    assert encoder.kind != "whole"
    assert [encoder.ids(t) for t in texts] == plain(path, texts)


def want_pieces(rows, length):
    out = []
    for (doc_id, text), ids in zip(rows, plain(WORD, [t or "" for _, t in rows])):
        ids += b"\0\0\0\0"
        for n, at in enumerate(range(0, len(ids), 4 * length)):
            part = ids[at:at + 4 * length]
            out.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
    return sorted(out, key=str)


def check_packing(table, length):
    got = packing.pack(table, WORD, length).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == want_pieces([(r.doc_id, r.text) for r in table.collect()], length)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(bins), -(-sum(r.length for r in got) // length)


def test_packing(docs, llm):
    bins, least = check_packing(docs.repartition(4), 2048)
    assert bins <= 1.02 * least + 1
    check_packing(awkward(llm), 64)
    assert packing.pack(empty(llm), WORD).collect() == []


def test_best_fit_takes_the_smallest_room():
    bins = packing.best_fit([(6, b"a"), (5, b"b"), (4, b"c"), (3, b"d"), (2, b"e")], 10)
    assert sorted(bins) == [(10, b"ac"), (10, b"bde")]


def check_store(table):
    store = tokenstore.write(table, BYTE)
    got = store.read(store.keys(), with_ids=True).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, want = 0, []
    for (doc_id, _), ids in zip(rows, plain(BYTE, [t for _, t in rows])):
        ids += b"\0\0\0\0"
        want.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == [(*w[:4], bytearray(w[4])) for w in want]
    return store


def test_store_round_trip(docs, llm):
    store = check_store(docs)
    keys = llm.createDataFrame([(True, 7, 0), (True, 10**9, 0), (True, 7, 1), (False, 0, 0)], "known boolean, doc_id long, occurrence int")
    assert [r.doc_id for r in store.read(keys).collect()] == [7]
    check_store(awkward(llm))
    assert check_store(empty(llm)).keys().count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    ids = np.random.default_rng(1).integers(-2**62, 2**62, 20_000)
    known, occurrence = np.ones(len(ids), np.uint8), np.zeros(len(ids), np.uint32)
    made = tokenstore.PerfectHash.build(known, ids, occurrence)
    assert sorted(made.slots(known, ids, occurrence)) == list(range(len(ids)))
    again, _ = tokenstore.PerfectHash.parse(made.dump())
    assert (again.slots(known, ids, occurrence) == made.slots(known, ids, occurrence)).all()
    with pytest.raises(ValueError):
        tokenstore.PerfectHash.build(known[:2], ids[[0, 0]], occurrence[:2])


def test_token_counts(docs, llm):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    scores, memo = tokencount.piece_scores(ranks), {}

    def count(word):
        if word not in memo:
            raw, best = word.encode(), [(0, 0)]
            for end in range(1, len(raw) + 1):
                best.append(max((best[s][0] + scores[raw[s:end]], best[s][1] - 1) for s in range(end) if raw[s:end] in scores))
            memo[word] = -best[-1][1]
        return memo[word]

    small = [r for r in ROWS if r[0] != 6]
    for table in (docs.limit(60), awkward(llm, small)):
        rows = table.collect()
        want = []
        for r in rows:
            cut = regex.findall(public_tokenizers.PATTERN, r.text or "")
            want.append((r.doc_id, len(cut), sum(map(count, cut))))
        for most in (tokencount.MOST_NODES, 50):
            got = tokencount.count_tokens(llm.createDataFrame(rows, table.schema), ranks, public_tokenizers.PATTERN, most).collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tokencount.count_tokens(empty(llm), ranks, public_tokenizers.PATTERN).collect() == []
