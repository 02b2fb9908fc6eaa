"""The driver contract: entry() runs, every query has an oracle."""

from __future__ import annotations

import os
import subprocess
import sys

import __spark_entry__ as contract
from auditlane.plans import registry


def test_every_query_of_the_reference_kind_has_oracle_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def _main_queries_only(block: str) -> str:
    """What the entry warns of where modules can't be imported; the other queries must be there."""
    code = (
        "import sys, warnings\n"
        "class Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        f"        if {block}: raise ModuleNotFoundError('No module named ' + name, name=name)\n"
        "sys.meta_path.insert(0, Block())\n"
        "import __spark_entry__ as e\n"
        "from auditlane.plans import registry as r\n"
        "with warnings.catch_warnings(record=True) as said:\n"
        "    warnings.simplefilter('always')\n"
        "    assert set(e.queries()) == set(r.QUERIES) and set(e.oracle_sql()) == set(r.ORACLE)\n"
        "print(said[0].message)"
    )
    return subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(contract.__file__), capture_output=True, text=True).stdout


def test_entry_does_without_the_training_data_operators():
    """As where their folders are deleted: the rest is registered all the same."""
    assert "auditlane.llm" in _main_queries_only("name.startswith(('auditlane.llm', 'corpus_pipeline'))")


def test_entry_does_without_a_library_of_theirs():
    assert "zstandard" in _main_queries_only("name == 'zstandard'")


def test_entry_runs_on_the_smoke_tables(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert len(rows) == 7 and {r.rule_id for r in rows if not r.success} == {"trip_id_unique"}
    assert df.columns == ["batch", "rule_index", "rule_id", "rule_type", "column", "mostly", "element_count",
                          "missing_count", "evaluated_count", "unexpected_count", "unexpected_percent", "success"]
