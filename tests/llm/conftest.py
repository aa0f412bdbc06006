import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from shelfwise.llm.common import prepared

    return prepared(spark)


@pytest.fixture(scope="session")
def docs(llm):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return llm.read.parquet(f"{SF_DIR}/documents.parquet")
