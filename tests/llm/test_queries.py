"""The registered queries: oracles, names, and the entry without this folder."""

import subprocess
import sys

import duckdb
import pytest

from lodestone.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_its_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.ORACLE[key])
    got = queries.QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_entry_without_the_folder():
    code = ("import sys; sys.modules['lodestone.llm'] = None\n"
            "import importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('lodestone.llm', 'corpus_pipeline')):\n"
            "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
            "del sys.modules['lodestone.llm']; sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q, o = e.queries(), e.oracle_sql()\n"
            "assert q and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in [*q, *o])\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=str(queries.__file__).split("/lodestone/llm/")[0], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]
