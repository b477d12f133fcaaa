"""The entry module imports anywhere: no jar, no table and no session at import time."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_spark_jars(tmp_path):
    code = (
        "import pyspark, sys\n"
        f"pyspark.__file__ = {str(tmp_path / '__init__.py')!r}\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), 'text_rank' in e.oracle_sql())"
    )
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode == 0, run.stderr
    queries, twins, ranked = run.stdout.split()
    assert int(queries) >= 76 and int(twins) >= 76 and ranked == "True"


def test_the_rest_works_without_the_corpus_libraries(tmp_path):
    code = (
        "import sys\n"
        "for name in ('public_tokenizers', 'tokenizers', 'regex'): sys.modules[name] = None\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    )
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode == 0, run.stderr
    queries, corpus = run.stdout.split()
    assert int(queries) >= 82 and corpus == "False" and "left out" in run.stderr
