"""The entry file stands without the training-data subpackage and without a package that it needs."""

import subprocess
import sys

ROOT = __file__.rsplit("/tests/", 1)[0]
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + '.'):
            raise ModuleNotFoundError('hidden: ' + name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, {root!r})
import __spark_entry__ as E
names = set(E.queries())
assert 'correlate' in names and set(E.oracle_sql()) <= names
print(len([n for n in names if n.startswith('op') and n[2].isdigit()]), 'pipeline' in names)
"""


def seen_without(name):
    out = subprocess.run([sys.executable, "-c", HIDE.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_without_a_package_that_only_the_subpackage_needs():
    assert seen_without("ahocorasick") == ["0", "False"]


def test_without_the_subpackage():
    assert seen_without("predlake.llm") == ["0", "False"]
