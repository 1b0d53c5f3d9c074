"""Without the training-data operators everything else imports and is registered."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_without_llm(tmp_path):
    for name in ("citeloom", "__spark_entry__.py"):
        source = REPO / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "citeloom" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q), q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    assert not any("citeloom.llm" in p.read_text() for p in (tmp_path / "citeloom").rglob("*.py"))
