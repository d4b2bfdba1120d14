"""The entry module with and without the optional part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(before: str) -> list[str]:
    code = f"import sys, warnings\nwarnings.simplefilter('ignore')\n{before}\nimport __spark_entry__ as e\n"
    code += "assert set(e.oracle_sql()) <= set(e.queries())\nprint(*sorted(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True, text=True, timeout=120)
    return run.stdout.split()


def test_without_the_optional_part_all_others_are_there():
    from marquee.suite.queries import QUERIES

    for absent in ("marquee.llm", "tokenizers", "corpus_pipeline"):
        # A module that is None is one that cannot be imported.
        left = set(names(f"sys.modules[{absent!r}] = None"))
        assert set(QUERIES) <= left
    assert set(names("sys.modules['marquee.llm'] = None")) == set(QUERIES)
