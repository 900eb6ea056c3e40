import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("citeweave-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="citeweave-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from citeweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def toy(spark):
    """The six-record toy corpus (FIXTURES.md section 2)."""
    rows = [
        ("1", "A", "J1", ["2", "3"]),
        ("2", "B", "J1", ["3", "3", "zz"]),
        ("3", "C", "J2", []),
        ("4", "D", "J3", ["4", "1"]),
        ("5", "E", "", []),
        ("6", "B", "", ["1"]),
    ]
    return spark.createDataFrame(rows, "id string, title string, journalName string, outCitations array<string>")
