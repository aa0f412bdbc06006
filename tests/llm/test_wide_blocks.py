"""Rows of megabytes are written, read and handed to Python by bytes, not by hundreds of rows."""

import pyarrow.parquet as pq
from helpers import awkward
from pyspark.sql import functions as F
from test_alignment import FIRST, SECOND

from shelfwise.llm import alignment, common
from shelfwise.session import materialise


def groups(frame):
    return [n.num_row_groups for f in frame.inputFiles() for n in [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata]]


def test_row_groups_of_wide_rows_are_bounded_by_bytes(llm):
    rows = llm.range(0, 24, 1, 1).select("id", F.expr("transform(sequence(1, 250000), x -> xxhash64(x, id))").alias("n"))  # 2 MB each
    assert groups(materialise(rows, "wide-test", wide=True))[0] >= 3
    assert materialise(rows, "wide-test", wide=True).agg(F.sum("id")).first()[0] == 276
    assert groups(materialise(rows, "wide-test")) == [1]


def test_blocks_are_handed_over_by_bytes(llm, monkeypatch):
    asked = []
    monkeypatch.setattr(alignment, "materialise", lambda df, name, wide=False: asked.append((name, wide)) or materialise(df, name, wide))
    alignment.compare(awkward(llm, [(1, "The cat and the dog", "en", "a")]), FIRST, SECOND)
    assert ("align-blocks", True) in asked and ("align-told", True) in asked
    assert llm.conf.get(common.BYTES_SETTING) == alignment.BATCH_BYTES
    assert common.prepared(llm).conf.get(common.BYTES_SETTING) == common.BATCH_BYTES
