"""Session helpers: cluster sizing, submitted settings, checkpoint folder."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from kardex.session import cut_lineage, ensure_checkpoint_dir, scale_conf

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scale_conf():
    conf = scale_conf(100 * 2 ** 40, 1000, 8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 * 2 ** 20, 10, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120  # at least three waves of tasks


def test_submitted_settings_win(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(
        "from kardex.session import get_session, scale_session\n"
        "s = get_session()\n"
        "scale_session(s, 1 << 40)\n"
        "c = s.sparkContext\n"
        "print('GOT', c.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.autoBroadcastJoinThreshold'),\n"
        "      s.conf.get('spark.sql.adaptive.skewJoin.skewedPartitionFactor'))\n")
    home = os.path.dirname(__import__("pyspark").__file__)
    run = subprocess.run(
        [f"{home}/bin/spark-submit", "--master", "local[3]", "--conf", "spark.sql.shuffle.partitions=77",
         "--conf", "spark.sql.autoBroadcastJoinThreshold=1234", "--conf", "spark.ui.enabled=false", str(job)],
        env=os.environ | {"PYTHONPATH": ROOT, "PYSPARK_PYTHON": sys.executable}, capture_output=True, text=True, timeout=120)
    assert "GOT local[3] 77 1234 4" in run.stdout, run.stderr[-2000:]


def test_checkpoint_dir_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(5))
    assert df.count() == 5


def test_unset_checkpoint_dir_is_an_error():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)
