"""Small groups beside a dense component: no link is lost, however few they are among all links."""

import numpy as np
import pytest

from shelfwise.llm import nndescent

DIM = 64


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def turned(x, rng, cosine):
    """Vectors at a cosine of `cosine` to those given."""
    other = rng.standard_normal(x.shape)
    other = unit(other - (other * x).sum(-1, keepdims=True) * x)
    return cosine * x + np.sqrt(1 - cosine ** 2) * other


def vectors(dense, pairs, seed):
    rng = np.random.default_rng(seed)
    one = unit(rng.standard_normal((1, DIM)))
    ball = turned(np.repeat(one, dense, 0), rng, 0.985)
    left = unit(rng.standard_normal((pairs, DIM)))
    return np.concatenate([ball, left, turned(left, rng, 0.94)])


def expected(x, least):
    n_links, parent = [], list(range(len(x)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for low in range(0, len(x), 500):
        near = x[low:low + 500] @ x.T >= least
        n_links += (near.sum(1) - 1).tolist()
        for i, row in enumerate(near, low):
            for j in np.flatnonzero(row[:i]):
                a, b = sorted((top(i), top(int(j))))
                parent[b] = a
    return [(i, n, top(i), top(i) == i) for i, n in enumerate(n_links)]


@pytest.mark.parametrize(("dense", "pairs", "turns"), [(3000, 4000, nndescent.TURNS), (700, 1500, 1)])
def test_no_group_is_lost(llm, dense, pairs, turns):
    """With all turns, and with the comparison across components after a single one."""
    x = unit(vectors(dense, pairs, dense))
    rows = [(i, 1, v) for i, v in enumerate(x.tolist())]
    table = llm.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    got = nndescent.link(table, turns=turns).collect()
    assert sorted(tuple(r) for r in got) == expected(x, nndescent.LEAST)


def test_orders_are_led_by_different_bytes(llm):
    sketch = bytes(range(64))
    row = llm.createDataFrame([(bytearray(sketch),)], "sketch binary").select(*[nndescent.order_code(i).alias(f"o{i}") for i in range(504)]).first()
    assert len({bytes(c)[:1] for c in row[:64]}) == 64 and all(len(set(bytes(c))) == 8 for c in row)
