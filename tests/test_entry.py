"""The entry point works with and without the optional training-data package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", ["zstandard", "xxhash", "corpus_pipeline", "clinicgen.llm"])
def test_hidden_modules_leave_the_generator_queries(hidden):
    code = (f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "print(len(q), len(o), sum(n.startswith('op') or n == 'pipeline' for n in q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert out == ["56", "56", "0"]


def test_scratch_folder_only_in_local_mode(monkeypatch):
    from clinicgen import session

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

        def getConf(self):
            return {}

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Context(master), {}

    for master in ("local-cluster[2,1,1024]", "spark://h:7077", "yarn", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session(master))
    for master in ("local", "local[8]", "local[*]", "local[4,2]"):
        assert session.ensure_checkpoint_dir(Session(master))
