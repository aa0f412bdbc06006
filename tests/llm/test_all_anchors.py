"""Fingerprints hold every anchor, however long the text."""

import random

from shelfwise.llm import syncmers


def prose(seed, n=100_000):
    return "".join(random.Random(seed).choices("abcdefghij ", k=n))


def test_long_texts_that_differ_in_a_sentence():
    text = prose(1)
    changed = text[:50_000] + prose(2, 80) + text[50_080:]
    a, b = syncmers.fingerprint(text), syncmers.fingerprint(changed)
    assert a != b and 0.99 < syncmers.likeness(a, b) < 1


def test_a_shared_passage_counts():
    passage = prose(3, 2_000)
    a, b = (syncmers.fingerprint(prose(s, 49_000) + passage + prose(s + 1, 49_000)) for s in (4, 6))
    assert 0.01 < syncmers.likeness(a, b) < 0.03


def test_all_anchors_with_their_places():
    for text in (prose(7, 3_000), "a" * 500, "ab" * 300):
        hashes, places = syncmers.anchors(text)
        print_ = syncmers.fingerprint(text)
        parts = [print_[i:i + syncmers.DIGITS] for i in range(0, len(print_), syncmers.DIGITS)]
        at, found = 0, []
        for p in parts:
            at += int(p[8], 16)
            found.append((int(p[:8], 16), at))
        assert found == list(zip(hashes.tolist(), places.tolist()))


def test_repeats_count():
    once, twice = prose(8, 1_000), prose(8, 1_000) * 2
    assert 0.6 < syncmers.likeness(syncmers.fingerprint(once), syncmers.fingerprint(twice)) < 0.7


def test_order_counts():
    one, two = prose(9, 3_000), prose(10, 3_000)
    assert 0.6 < syncmers.likeness(syncmers.fingerprint(one + two), syncmers.fingerprint(two + one)) < 0.7
