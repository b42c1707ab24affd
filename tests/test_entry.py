"""The entry file with all its parts, without the operators on training text, and without a package they need."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("hidden", [[], ["xxhash"], ["tiktoken", "public_tokenizers"], ["larder.llm"], ["corpus_pipeline"]])
def test_other_queries_stay_when_a_part_cannot_be_imported(hidden):
    code = f"""
import sys
for name in {hidden!r}:
    sys.modules[name] = None  # as if it were not installed
import __spark_entry__ as entry
from larder.queries import CHECKS, QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
assert set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()) - len(QUERIES))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=HERE, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    more = int(done.stdout)
    if os.path.isdir(os.path.join(HERE, "larder", "llm")) and hidden in ([], ["corpus_pipeline"]):
        assert more >= 13
    if "larder.llm" in hidden or "xxhash" in hidden:
        assert more == 0
