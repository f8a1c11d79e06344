import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]
BLOCKED = """
import sys

class Block:
    def find_spec(self, name, path=None, target=None):
        if name in {gone} or any(name.startswith(g + ".") for g in {gone}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
names = entry.queries()
assert "extent_metrics" in names and "param_search" in entry.oracle_sql() and "pipeline" not in names, sorted(names)
assert not any(n.startswith("op1_") for n in names)
"""


def test_entry_without_the_training_data_operators():
    for gone in (["acreage.llm"], ["acreage.llm", "corpus_pipeline"]):
        subprocess.run([sys.executable, "-c", BLOCKED.format(gone=gone)], cwd=ROOT, check=True)
