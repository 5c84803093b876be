import re
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_registered_names_have_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)
    own = {q for q in queries if not (q.startswith("op") and q[2].isdigit()) and q != "pipeline"}
    assert own == own & set(sql)


def test_entry_without_the_optional_part(tmp_path):
    shutil.copytree(ROOT / "evigrid", tmp_path / "evigrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[-1] == "False" and int(done.stdout.split()[0]) > 60


def test_nothing_outside_imports_the_optional_part():
    for path in [p for p in (ROOT / "evigrid").rglob("*.py") if "llm" not in p.parts]:
        assert not re.search(r"^\s*(from|import) .*\bllm\b", path.read_text(), re.M), path
