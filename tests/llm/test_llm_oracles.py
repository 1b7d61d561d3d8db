"""Queries with SQL against DuckDB; the entry point with and without this folder."""

import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from basketry.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == sorted(str(r) for r in cur.fetchall())


def test_one_query_each():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())


def test_entry_imports_without_this_folder():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'basketry.llm') or name.startswith('basketry.llm.'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E\n"
            "assert 'pipeline' not in E.queries() and not any(n.startswith('op1_') for n in E.queries())\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=E.__file__.rsplit("/", 1)[0])
