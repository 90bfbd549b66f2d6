"""The entry offers the core's queries also where the text operators, or what they need, are absent."""

import os
import subprocess
import sys

import pytest

REPOSITORY = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys, warnings
sys.modules[{name!r}] = None
warnings.simplefilter("error" if {quiet} else "ignore")
import __spark_entry__ as entry
assert "fact_entity" in entry.queries() and "fact_entity" in entry.oracle_sql()
assert not [n for n in entry.queries() if n.startswith("op") and n[2:3].isdigit() or n == "pipeline"]
"""


@pytest.mark.parametrize("name, quiet", [("public_tokenizers", False), ("xxhash", False), ("corpus_pipeline", True)])
def test_core_without_the_text_operators(name, quiet):
    subprocess.run([sys.executable, "-c", CODE.format(name=name, quiet=quiet)], check=True, cwd=REPOSITORY)


def test_a_broken_module_of_our_own_is_no_absence():
    code = "import sys; sys.modules['tidemark.staging'] = None; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=REPOSITORY)
    assert done.returncode and "tidemark.staging" in done.stderr
