import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wayfleet.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("wayfleet-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def batches(tmp_path):
    """Write one text file per micro-batch; returns the folder."""
    import os

    def write(*files, name="in"):
        folder = tmp_path / name
        folder.mkdir()
        for i, lines in enumerate(files):
            path = folder / f"{i:03d}.txt"
            path.write_text("".join(line + "\n" for line in lines))
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        return str(folder)

    return write


@pytest.fixture(scope="session")
def same():
    """Two frames hold the same rows, duplicates included, whatever their order."""

    def check(left, right):
        return left.columns == right.columns and Counter(map(repr, left.collect())) == Counter(map(repr, right.collect()))

    return check
