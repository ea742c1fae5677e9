import os

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["cluster", "n_nodes"]


def test_oracles_cover_registered_queries():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    rows_only = {n for n in set(q) - set(s) if not n.startswith("op") and n != "pipeline"}
    assert not rows_only


def test_runs_from_a_foreign_folder(tmp_path):
    """The Python workers import the package although only the driver's path
    has it."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '2').getOrCreate(); "
            "print('ROWS', E.queries()['dgim_published'](s, '/root/testdata/sf0.001').count())"
            % os.path.dirname(os.path.abspath(E.__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]
