"""Driver contract: entry, query/oracle registry and DuckDB parity on sf0.001."""
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of
from tripflow.plans.registry import QUERIES

from conftest import SF0001

OWN = set(QUERIES)          # other queries have their own tests
SLOW = {"demand_stream", "score_trips", "score_fares", "score_demand"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["zone_id", "zone_avg_fare", "zone_avg_duration_min", "zone_avg_distance",
                          "zone_trip_count", "event_timestamp"]


def test_oracles_cover_queries():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and OWN <= set(qs)
    assert OWN - set(orc) == {"score_trips", "score_fares", "score_demand"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(OWN & set(E.oracle_sql()) - SLOW))
def test_parity_sf0001(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, cur.fetchall())


PLAN_SKIP = SLOW | {"score_trips", "score_fares", "score_demand"}


@pytest.mark.parametrize("name", sorted(OWN - PLAN_SKIP))
def test_no_cross_joins_in_plans(spark, name):
    """Scale guard: no registered query plans a cartesian product or a
    nested-loop join."""
    plan = E.queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_without_the_training_data_operators(tmp_path):
    """A copy of the entry beside the library alone has the library's queries; any other import error shows."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/tripflow", tmp_path / "tripflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()), len(e.oracle_sql()))"],
                                 cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False)
    first = run()
    assert first.returncode == 0 and first.stdout.startswith(str(sorted(OWN))), first.stderr
    (tmp_path / "tripflow" / "llm").mkdir()
    assert run().returncode == 0            # an empty folder is no subpackage
    (tmp_path / "tripflow" / "llm" / "__init__.py").write_text("")
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_library\n")
    assert "no_such_library" in run().stderr
