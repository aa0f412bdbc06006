"""Exact deduplication against a dictionary of texts, in one batch and in many, with weak digests."""

import hashlib

import pytest
from helpers import UPPER, awkward, empty
from pyspark.sql import functions as F

from shelfwise.llm import exactdedup
from shelfwise.session import scratch_path


def by_hand(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(UPPER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), at == stays, sha) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def got(frame):
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, frame.collect()), key=str)


def written(spark, frame, files=3):
    path = scratch_path(spark, "exact-test")
    frame.repartition(files).write.parquet(path)
    return path


MORE = [(i, f"Copy {i % 4} Ä", "en", "a") for i in range(40, 60)] + [(i, "THE SAME", "en", "b") for i in range(60, 90)] + [
    (None, "no id at all", "en", "a"), (None, "NO id at all", "en", "a"), (None, "the same", None, None)]


def test_given_documents(docs, llm):
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert got(exactdedup.duplicates(llm, "/root/testdata/sf0.001/documents.parquet")) == want


@pytest.mark.parametrize("digest", [None, lambda sha: F.substring(sha, 1, 1), lambda sha: F.lit("x")])
def test_digests_that_clash_change_nothing(llm, digest):
    table = awkward(llm, [(i, t, lang, s) for i, t, lang, s in MORE] + [(1, "x", "en", "a"), (1, "X", "en", "a"), (2, "", "en", "a"), (3, None, "en", "a")])
    options = {} if digest is None else {"digest": digest}
    assert got(exactdedup.duplicates(llm, written(llm, table), files_per_batch=1, **options)) == by_hand([(r.doc_id, r.text) for r in table.collect()])


def test_awkward_and_empty_tables(llm):
    table = awkward(llm)
    assert got(exactdedup.duplicates(llm, written(llm, table))) == by_hand([(r.doc_id, r.text) for r in table.collect()])
    assert got(exactdedup.duplicates(llm, written(llm, empty(llm)))) == []


def test_files_that_come_later(llm):
    """Each call takes the new files only, and hits look into files of earlier calls."""
    first, second = awkward(llm, MORE[:25]), awkward(llm, MORE[20:])
    path = written(llm, first)
    weak = lambda sha: F.substring(sha, 1, 1)
    root = scratch_path(llm, "exact-root")
    store = exactdedup.Store(llm, path, root, digest=weak).advance()
    rows = [(r.doc_id, r.text) for r in first.collect()]
    assert got(store.members()) == by_hand(rows)
    second.write.mode("append").parquet(path)
    again = exactdedup.Store(llm, path, root, digest=weak).advance().advance()
    assert got(again.members()) == by_hand(rows + [(r.doc_id, r.text) for r in second.collect()])
    runs = llm.read.parquet(f"{root}/digests").where("run >= 0").select("run").distinct().count()
    assert runs == 2


def test_batch_that_is_replayed(llm):
    """A batch noted twice, as after a lost driver, leaves the same tables."""
    path = written(llm, awkward(llm, MORE))
    store = exactdedup.Store(llm, path).advance()
    want = got(store.members())
    rows = store.table("digests", exactdedup.DIGESTS).where("run = 0").drop("run").collect()
    state = llm.createDataFrame(rows, exactdedup.DIGESTS.rsplit(",", 1)[0])
    store._note_state(state, 0)
    assert got(store.members()) == want
