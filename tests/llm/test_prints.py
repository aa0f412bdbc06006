import hashlib
import random

import numpy as np
import pytest
import xxhash
from helpers import awkward, empty, words
from pyspark.sql import functions as F

from shelfwise.llm import simhash, syncmers
from shelfwise.llm.common import components


def brute_print(text):
    w = words(text)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, most=2):
    prints = np.array(prints, np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= most
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def check(table):
    rows = table.collect()
    prints = [brute_print(r.text) for r in rows]
    group = brute_groups(prints)
    least = {}
    for r, g in zip(rows, group):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, group)]
    assert sorted(map(tuple, simhash.near_duplicates(table).collect()), key=str) == sorted(want, key=str)
    kept = simhash.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((least.get(g) for g in set(group)), key=str)


def test_simhash(docs, llm):
    check(docs)
    check(awkward(llm))
    assert simhash.near_duplicates(empty(llm)).collect() == []


@pytest.mark.parametrize("group", [simhash.GROUP, 5, 1])
def test_links_connect_the_same(llm, group):
    """Fingerprints drawn near each other and far apart, whatever the depth of the nodes."""
    rng = random.Random(group)
    prints = {0}
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(at)
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    fps = llm.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    roots = {r.node: r.component for r in components(simhash.links(fps, 2, group), "test").collect()}
    got = [roots.get(simhash.signed(p), simhash.signed(p)) for p in prints]
    want = brute_groups(prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_tree_search_is_exact():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    query, found = simhash.search(simhash.tree(codes), codes, 2)
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= 2
    assert sorted(zip(query, found)) == sorted(zip(*np.nonzero(near)))


def test_components(llm):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500, i) for i in range(501, 600)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(llm.createDataFrame(edges, "a long, b long"), "test").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def check_syncmers(table):
    rows = [(r.doc_id, r.text) for r in table.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").desc_nulls_last(), F.col("h").desc()).collect()]
    want = []
    for at, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        own, changed = syncmers.fingerprint(text), syncmers.fingerprint(edited)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed,
                     syncmers.likeness(own, changed), syncmers.likeness(own, syncmers.fingerprint(after))))
    got = [tuple(r) for r in syncmers.compare(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_syncmers(docs, llm):
    got = check_syncmers(docs)
    assert sum(r[5] > r[6] for r in got) > 0.9 * len(got)
    check_syncmers(awkward(llm))
    check_syncmers(awkward(llm, [(1, "only one document here", "en", "a")]))
    assert syncmers.compare(empty(llm)).collect() == []


def test_syncmers_are_context_free():
    rng = random.Random(2)
    middle, left, right = ("".join(rng.choices("abcdefgh ", k=400)) for _ in range(3))
    alone, at = syncmers.anchors(middle)
    placed, where = syncmers.anchors(left + middle + right)
    inside = {(h, p - 400) for h, p in zip(placed.tolist(), where.tolist())}
    assert set(zip(alone.tolist(), at.tolist())) <= inside


def test_chosen_kmers_by_definition():
    text = "".join(random.Random(4).choices("abcd", k=200))
    codes = np.array([ord(c) for c in text], np.uint64)
    one = syncmers.scramble(codes + np.uint64(syncmers.BASE))

    def inner(at):
        value = 0
        for i in range(syncmers.S):
            value = (value * syncmers.BASE + int(one[at + i])) % (1 << 64)
        return int(syncmers.scramble(np.array([value], np.uint64))[0])

    span = syncmers.K - syncmers.S
    want = [i for i in range(len(text) - syncmers.K + 1) if min(inner(i + j) for j in range(span + 1)) in (inner(i), inner(i + span))]
    assert syncmers.anchors(text)[1].tolist() == want


def test_likeness_bounds():
    a = syncmers.fingerprint("some words that make a text of some length, and then some more")
    assert syncmers.likeness(a, a) == 1 and syncmers.likeness("", "") == 1 and syncmers.likeness(a, "") == 0
