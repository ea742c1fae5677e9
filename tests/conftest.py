import os
import sys
import tempfile
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore", category=FutureWarning)
os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from netstream.session import build_session
    ckpt = tempfile.mkdtemp(prefix="netstream-test-ckpt-")
    s = build_session("local[4]", app="netstream-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


def edges_df(spark, pairs):
    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "src LONG, dst LONG")


def triangle(base=0):
    a, b, c = base, base + 1, base + 2
    return [(a, b), (a, c), (b, c)]
