"""Every query with oracle SQL gives the same rows, column names and types as DuckDB."""

import os

import pytest
from conftest import SMALL

from loamwork.plans import ORACLES, QUERIES
from tools.compare import compare, type_notes


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    verdict = compare(rows, result.fetchall(), df.columns, list(kinds))
    assert verdict.startswith("ok"), verdict
    assert type_notes(dict(df.dtypes), kinds) == ""


def test_entry_and_keys(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_all_other_queries_stay_without_the_corpus_operators():
    """Any import that fails below the subpackage leaves out its queries only."""
    import subprocess
    import sys

    code = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in %r:
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), sum(q.startswith("op") and q[2].isdigit() or q == "pipeline" for q in e.queries()))
"""
    for missing in (("corpus_pipeline",), ("loamwork.llm",), ("public_tokenizers",), ("loamwork.llm.search",)):
        said = subprocess.run([sys.executable, "-c", code % (missing,)], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        assert said.stdout.split() == [str(len(QUERIES)), "0"]


@pytest.mark.parametrize("name", ["looks_like_duplicate"])
def test_short_lines_of_the_larger_table(spark, name):
    """Lines that are too short to be cut stand in the larger table only."""
    import duckdb

    larger = SMALL.replace("sf0.001", "sf0.01")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{larger}/documents.parquet'")
    df = QUERIES[name](spark, larger)
    assert compare([tuple(r) for r in df.collect()], con.execute(ORACLES[name]).fetchall(), df.columns, [d[0] for d in con.execute(ORACLES[name]).description]).startswith("ok")
