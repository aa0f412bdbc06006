import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, crc, empty, words

from shelfwise.llm import nndescent, suffixtree


def check_scores(table, word_share):
    rows = table.collect()
    tokens = [words(r.text) + [""] for r in rows]
    held = [r.doc_id is None or crc(r.doc_id) % 7 == 2 for r in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, kinds = sum(c.values()), len(c)
    want = []
    for r, t, h in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in t)
        want.append((r.doc_id, h, len(t), sum(w in c for w in t), total, round(base, 6)))
    got = suffixtree.score(table, word_share=word_share).collect()
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(math.isfinite(r.score) for r in got)
    return got


@pytest.mark.parametrize("word_share", [suffixtree.WORD_SHARE, 0.002])
def test_scores(docs, llm, word_share):
    """Words of the join and of the broadcast give the same; the tree beats the base on unseen texts."""
    got = check_scores(docs, word_share)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_of_awkward_rows(llm):
    check_scores(awkward(llm), suffixtree.WORD_SHARE)
    assert suffixtree.score(empty(llm)).collect() == []
    nothing = suffixtree.score(awkward(llm, [(None, "a b", "en", "a")])).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in nothing] == [(0, 0, 0.0, 0.0)]


def small_tree():
    root = np.log10(np.array([1e-300, 0.25, 0.25, 0.25, 0.25]))
    tree = suffixtree.Tree(root)
    n = np.array([90, 5, 5, 40, 60.0])
    tree.add_level(np.array([3, 4]), np.array([100.0, 100.0]), np.array([3.0, 2.0]), np.array([0, 0, 0, 1, 1]), np.array([4, 3, 1, 1, 4]), n)
    return tree


def test_states_and_distributions():
    """A diverging context is a state, one like its suffix is not, and every state sums to one."""
    tree = small_tree()
    assert tree.levels[0].contexts.tolist() == [3, 4]
    for row in range(2):
        assert math.isclose(sum(10 ** tree.log(1, np.full(5, row), np.arange(5))), 1, rel_tol=1e-9)
    tree.add_level(np.array([3 << 16 | 4, 4 << 16 | 3]), np.array([100.0, 100.0]), np.array([4.0, 2.0]),
                   np.array([0, 0, 1, 1]), np.array([1, 4, 1, 2]), np.array([40, 60, 99, 1]))
    assert tree.levels[1].contexts.tolist() == [4 << 16 | 3]
    stream, place = np.array([0, 4, 3, 1]), np.array([0, 1, 2, 3])
    lifts = tree.lifts(stream, place)
    assert lifts[0] == 0 and math.isclose(lifts[3], float(tree.log(2, np.array([0]), np.array([1]))[0]) - tree.root[1])
    assert math.isclose(lifts[2], float(tree.log(1, np.array([1]), np.array([3]))[0]) - tree.root[3])


def planted(seed, dim=24):
    """Loose vectors, groups of copies, near copies and chains, in three labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        for _ in range(150):
            rows.append((label, rng.standard_normal(dim)))
        for size in (2, 3, 40, 5):
            centre = rng.standard_normal(dim)
            for _ in range(size):
                rows.append((label, centre + 0.22 * rng.standard_normal(dim)))
        copy = rng.standard_normal(dim)
        rows += [(label, copy)] * 4 + [(label, 3.0 * copy)]
    return [(i, label, [float(x) for x in v]) for i, (label, v) in enumerate(rows)]


def brute(rows):
    groups, links, comp = defaultdict(list), {}, {}
    for at, (_, label, v) in enumerate(rows):
        links[at], comp[at] = 0, at
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            groups[label, len(v)].append(at)
    for members in groups.values():
        x = np.array([rows[i][2] for i in members])
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= nndescent.LEAST
        np.fill_diagonal(near, True)
        label = np.arange(len(members))
        while True:
            new = np.array([label[row].min() for row in near])
            if (new == label).all():
                break
            label = new
        for k, i in enumerate(members):
            links[i], comp[i] = int(near[k].sum()) - 1, members[label[k]]
    least = {}
    for at, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            least[comp[at]] = min(least.get(comp[at], vec_id), vec_id)
    return [(r[0], links[at], least.get(comp[at]), r[0] == least.get(comp[at])) for at, r in enumerate(rows)]


SCHEMA = "vec_id long, label int, embedding array<double>, node string, unit string, places string"


def check_links(llm, rows):
    table = llm.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = nndescent.link(table).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_links(llm):
    check_links(llm, planted(1))


def test_awkward_vectors(llm):
    v = [1.0, 2.0, 3.0]
    check_links(llm, [
        (1, 0, v), (2, 0, v), (2, 0, v), (3, None, v), (4, 0, None), (5, 0, []), (6, 0, [0.0, 0.0, 0.0]), (7, 0, [1.0, None, 2.0]),
        (8, 0, [float("nan"), 1.0, 1.0]), (9, 0, [float("inf"), 1.0, 1.0]), (10, 1, v), (11, 0, [1.0, 2.0]), (12, 0, [1e100, 2e100, 3e100]),
        (13, 0, [-1.0, -2.0, -3.0]), (None, 1, v), (None, 7, v)])
    assert nndescent.link(llm.createDataFrame([], SCHEMA)).collect() == []


def test_counts_over_several_blocks(llm, monkeypatch):
    monkeypatch.setattr(nndescent, "BLOCK", 7)
    check_links(llm, planted(2)[:120] + planted(2)[150:204])
