"""The library stands without the training-data operators, and uses nothing that a lost executor would take along."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_stands_without_llm(tmp_path):
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and len(q) > 60 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})


def test_nothing_else_imports_llm():
    for p in (ROOT / "tessera").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "tessera").parts[:1]:
            assert "tessera.llm" not in p.read_text(), p


def test_no_local_checkpoints():
    for p in (ROOT / "tessera").rglob("*.py"):
        assert "localCheckpoint" not in p.read_text() and "crossJoin" not in p.read_text(), p


def test_errors_inside_llm_are_not_hidden(tmp_path):
    """Only a missing subpackage takes its queries away; a fault in it is raised."""
    if not (ROOT / "tessera" / "llm").exists():
        return
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    for p in (tmp_path / "tessera" / "llm").glob("bpe.py"):
        p.write_text("import a_module_that_is_not_there\n")
    code = "import __spark_entry__ as e\ntry:\n    e.queries()\nexcept ImportError as x:\n    assert 'not_there' in str(x)\nelse:\n    raise SystemExit(1)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from tessera.operators.state import shared_folder

    def session(master, folder=None):
        none = SimpleNamespace(isDefined=lambda: False)
        context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)), setCheckpointDir=lambda p: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=context)

    assert shared_folder(session("yarn", "hdfs://x/")) == "hdfs://x"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://https://h"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
    assert "tessera-" in shared_folder(session("local[8]"))
