"""The entry module without the optional corpus operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code: str) -> str:
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout


def test_imports_without_the_subpackage():
    code = ("import sys; sys.modules['{0}'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))")
    for gone in ("pitwall.llm", "corpus_pipeline"):
        n, m, corpus = _run(code.format(gone)).split()
        assert int(n) == int(m) > 40 and corpus == "False"


def test_library_never_imports_the_subpackage():
    code = "import sys; from pitwall.plans import catalog; print([m for m in sys.modules if m.startswith('pitwall.llm')])"
    assert _run(code).strip() == "[]"
