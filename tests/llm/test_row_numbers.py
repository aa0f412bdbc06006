"""Decisions on rows hold when the rows are split anew before they are read again."""

from collections import Counter

import pytest
from helpers import awkward

from shelfwise.llm import mixing, simhash
from shelfwise.session import materialise

PARTS = "spark.sql.files.minPartitionNum"


@pytest.mark.parametrize("stage", [mixing.emit, simhash.one_of_each])
def test_rows_split_anew(llm, stage):
    table = materialise(awkward(llm, [(i, f"text {i} of its own " + "word " * i, "en", "ab"[i % 2]) for i in range(60)]), "split")
    try:
        llm.conf.set(PARTS, "3")
        want = Counter(r.doc_id for r in stage(table).collect())
        lazy = stage(table)
        llm.conf.set(PARTS, "1")
        assert Counter(r.doc_id for r in lazy.collect()) == want
    finally:
        llm.conf.unset(PARTS)
