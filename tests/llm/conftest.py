import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
