"""The rounds over blocks and shards give the tree that one process makes of all counts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, crc, words

from shelfwise.llm import suffixtree as S


def by_hand(rows, depth):
    """Scores with every context and every pair counted."""
    tokens = [[w.encode() for w in words(r.text)] + [b""] for r in rows]
    train = [r.doc_id is not None and crc(r.doc_id) % 7 != 2 for r in rows]
    n = Counter(w for t, use in zip(tokens, train) if use for w in t)
    rare = {w: k for w, k in n.items() if k < S.SYMBOL_LEAST and w}
    endings = [e for size in (3, 2) for e, k in sum((Counter({w[-size:]: k}) for w, k in rare.items() if len(w) >= size), Counter()).items()
               if k >= S.ENDING_SHARE * sum(rare.values())]
    symbols = S.Symbols([w for w in n if w and w not in rare], endings)
    mass = defaultdict(int)
    for w, k in n.items():
        mass[symbols.of(w)] += k + 1
    denominator = sum(n.values()) + len(n) + 1
    with np.errstate(divide="ignore"):
        tree = S.Tree(np.log10(np.array([0] + [mass[i] or 1 for i in range(1, symbols.size)]) / denominator))
    streams = [[S.START_SYMBOL] + [symbols.of(w) for w in t] for t in tokens]
    for length in range(1, depth + 1):
        after = defaultdict(Counter)
        for s, use in zip(streams, train):
            for at in range(length, len(s) if use else 0):
                key = 0
                for x in s[at - length:at]:
                    key = key << S.SYMBOL_BITS | x
                after[key][s[at]] += 1
        contexts = sorted(c for c, k in after.items() if sum(k.values()) >= S.CONTEXT_LEAST)
        triples = [(row, x, k) for row, c in enumerate(contexts) for x, k in after[c].items()]
        row, symbol, count = (np.array([t[i] for t in triples], np.int64) for i in range(3))
        tree.add_level(np.array(contexts, np.int64), np.array([float(sum(after[c].values())) for c in contexts]),
                       np.array([float(len(after[c])) for c in contexts]), row, symbol, count)
    out = []
    for r, t, s in zip(rows, tokens, streams):
        base = math.fsum(math.log10((n[w] + 1) / denominator) for w in t)
        out.append((str(r.doc_id), round(base, 6), base + tree.lifts(np.array(s), np.arange(len(s))).sum()))
    return sorted(out), tree.states()


def check(table, depth=S.DEPTH, **more):
    want, states = by_hand(table.collect(), depth)
    got = sorted((str(r.doc_id), round(r.base_score, 6), r.score) for r in S.score(table, depth=depth, **more).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9, atol=1e-7)
    return states


def sentences(seed, copies=0):
    """Texts of 300 words in no order; the last ones are there twice."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}{rng.choice(['ing', 'ed', 'er'])}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(120)]
    texts += texts[-copies:] if copies else []
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


def test_given_documents(docs):
    assert check(docs.where("length(text) < 20000").limit(120)) > 500


def test_awkward_rows(llm):
    check(awkward(llm))


@pytest.mark.parametrize("depth", [1, 3])
def test_other_depths(llm, depth):
    check(awkward(llm, sentences(1)[:50]), depth)


def test_small_blocks_and_shards_and_hot_contexts(llm, monkeypatch):
    """Contexts over several shards, blocks of one text, words by broadcast and by join: the same."""
    monkeypatch.setattr(S, "BLOCK", 500)
    monkeypatch.setattr(S, "SHARD", 300)
    monkeypatch.setattr(S, "HOT", 20)
    check(awkward(llm, sentences(2, 20)), word_share=0.004)


def test_rare_contexts_are_learned_however_large_the_table(llm):
    """Texts that occur twice among many others: their contexts have a tiny share of all tokens, and are states."""
    rows = sentences(3, 30) + [(1000 + i, "the and of " * 4000, "en", "a") for i in range(20)]
    found = {r.doc_id: (r.score - r.base_score) / r.n_tokens for r in S.score(awkward(llm, rows)).where("not held_out").collect()}
    twice = [i for i in range(90, 120) if i in found and i + 30 in found]
    once = [i for i in range(90) if i in found]
    assert min(found[i] for i in twice) > max(found[i] for i in once) + 0.5
