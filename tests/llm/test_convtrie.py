"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from shelfwise.llm import convtrie
from shelfwise.session import scratch_path

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth long, parent long, place long, a long, part long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(3)


def by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, key), role, text))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    below = {p: [0, 0, 0] for p in members}
    for path in sorted(members, key=len, reverse=True):
        here = below[path]
        here[1] = here[1] if here[0] else 1
        here[2] += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        if path:
            above = below[path[:-1]]
            above[0] += 1
            above[1] += here[1]
            above[2] += here[2]
    out = []
    for path, cs in members.items():
        ended = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(path))))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), *below[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    assert [f.dataType for f in frame.schema] == [T.LongType()] * 7 + [T.StringType()]
    return sorted(map(tuple, frame.collect()), key=str)


def made(n, longest, seed):
    rng = random.Random(seed)
    words = ["a", "b", "Ä\U0001f600", "", None]
    return [(c, t, rng.choice(["user", "assistant", None]) if t > 4 else "user", rng.choice(words) if t > 2 else "same")
            for c in rng.sample(range(-150, 400), n) for t in range(rng.randint(1, longest))]


def test_given_conversations(llm):
    rows = llm.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(convtrie.trie(rows)) == by_hand([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


@pytest.mark.parametrize(("fan", "band", "queue", "piece"), [(256, 1 << 20, 200_000, 65_536), (2, 2, 2, 3)])
def test_awkward_conversations(llm, fan, band, queue, piece):
    """Copies, shared first turns, a long conversation, nulls, repeated and missing turns."""
    rows = made(60, 9, 1) + [(500, t, "user", f"t{t % 7}") for t in range(60)]
    rows += [(None, 0, "user", "x"), (201, None, "user", "n"), (201, None, None, "n"), (201, 3, "z", "q"), (201, 3, "z", "q")]
    rows += [(600 + i, t, "user", f"copy{t}") for i in range(80) for t in range(6)]
    assert got(convtrie.trie(table(llm, rows), fan=fan, band=band, queue=queue, piece=piece)) == by_hand(rows)


def test_few_rows(llm):
    assert convtrie.trie(table(llm, [])).collect() == []
    assert convtrie.trie(table(llm, [(None, 1, "a", "b")])).collect() == []
    turnless = next(c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 > 2 and c % 100)
    for rows in ([(turnless, 0, "u", "x")], [(turnless, 0, "u", "x"), (300, 0, None, None)], [(1, 0, "u", "y" * 1_000_000)]):
        assert got(convtrie.trie(table(llm, rows))) == by_hand(rows)


def test_queue_spills(llm):
    rng = random.Random(3)
    queue, held, out, want = convtrie.SpillingQueue(scratch_path(llm, "queue"), 5), [], [], []
    for i in range(400):
        if held and rng.random() < 0.4:
            held.sort()
            want.append(held.pop(0))
            assert queue.peek() == want[-1]
            out.append(queue.pop())
        entry = (rng.randrange(9), rng.randrange(50), i, 0, 0)
        held.append(entry)
        queue.push(entry)
    while queue.peek():
        out.append(queue.pop())
    assert out == want + sorted(held)
