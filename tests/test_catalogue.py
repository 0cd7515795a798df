"""Every registered query against its SQL, and the entry points with and without the removable part."""

import math
import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tarnwork.plans import catalogue

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return ("nan" if math.isnan(v) else round(v, 9) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    build, sql = catalogue.REGISTRY[name]
    assert sql, "every query here has an oracle"
    df, rel = build(spark, SF), con.sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert Counter(tuple(plain(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_removable_part(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'severity_monthly' in q and not any(k.startswith('op1_') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, check=True, timeout=120)
