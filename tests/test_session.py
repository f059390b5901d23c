import subprocess
import sys

import pytest

from hourcast import session as SE


def test_existing_shuffle_partitions_are_kept():
    """In a process of its own, so that the suite's session stays as it is."""
    code = ("from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '4000').getOrCreate()\n"
            "from hourcast.session import build_session\n"
            "t = build_session()\n"
            "print('kept', t.conf.get('spark.sql.shuffle.partitions'), t.sparkContext.master)\n")
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=SE.os.path.dirname(SE.os.path.dirname(SE.__file__)))
    assert "kept 4000 local[2]" in got.stdout, got.stderr[-500:]


def test_no_local_scratch_off_a_local_master(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.ensure_checkpoint_dir(Session())


def test_is_directory(spark, tmp_path):
    file = tmp_path / "x.txt"
    file.write_text("x")
    assert SE.is_directory(spark, str(tmp_path)) and not SE.is_directory(spark, str(file))
    assert not SE.is_directory(spark, str(tmp_path / "missing"))
    with pytest.raises(Exception):
        SE.is_directory(spark, "nosuchscheme://x/y")
