import glob
import os
import re
from types import SimpleNamespace

import pytest

from assocspark import configure, scratch_dir
from conftest import ROOT


def session_with(folder, master="local[2]"):
    """A session stub: the checkpoint folder of a real one is fixed at its start."""
    settings = {"spark.checkpoint.dir": folder, "spark.master": master}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key) or default))


def test_scratch_folders_are_fresh_and_below_the_shared_folder():
    first, second = scratch_dir(session_with("hdfs://shared/x")), scratch_dir(session_with("hdfs://shared/x"))
    assert first != second and os.path.dirname(first) == "hdfs://shared/x"
    assert os.path.isdir(scratch_dir(session_with(None)))
    with pytest.raises(ValueError, match="share"):
        scratch_dir(session_with(None, "spark://host:7077"))


def test_configure(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert configure(spark, 500).conf.get(key) == "500"
    finally:
        spark.conf.unset(key)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_package_forces_no_broadcast_and_runs_no_row_wise_python():
    paths = [p for p in glob.glob(f"{ROOT}/assocspark/**/*.py", recursive=True) if "/llm/" not in p]  # it has tests of its own
    code = "".join(open(p).read() for p in paths)
    for word in (r"broadcast\(", r"\.rdd\b", "localCheckpoint", r"F\.udf", "pandas_udf", "toPandas", "applyInPandas"):
        assert not re.search(word, code), word
