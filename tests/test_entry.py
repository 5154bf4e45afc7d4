"""The registry with and without its optional parts."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
hidden = {hidden!r}
class Hider:
    def find_spec(self, name, path=None, target=None):
        if name in hidden:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hider())
import __spark_entry__ as entry
print(*entry.queries())
"""


def names_without(*hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=set(hidden))], cwd=ROOT, capture_output=True, text=True)
    return done.stdout.split(), done.stderr


def test_without_text_operators():
    from waybill.queries import QUERIES
    names, error = names_without("waybill.llm", "corpus_pipeline")
    assert names == list(QUERIES), error


def test_other_import_errors_are_raised():
    names, error = names_without("waybill.operators.latest")
    assert not names and "ImportError" in error


def test_without_a_package_that_the_text_operators_need():
    from waybill.queries import QUERIES
    names, error = names_without("public_tokenizers")
    assert names == list(QUERIES), error
