import numpy as np
import pandas as pd

from netstream.operators.indexing import following, keyed_prefix_sum, row_index


def skewed(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))
    pdf = pd.DataFrame({"k": keys.astype("int64"), "o": rng.permutation(n).astype("int64"),
                        "v": rng.integers(0, 5, n).astype("int64")})
    return spark.createDataFrame(pdf), pdf


def test_row_index_global_and_grouped(spark):
    df, pdf = skewed(spark)
    g = row_index(df, order="o", index_col="i").toPandas().sort_values("o")
    assert g["i"].tolist() == list(range(len(pdf)))
    gr = row_index(df, order="o", group="k", index_col="i", partitions=7).toPandas()
    exp = pdf.sort_values("o").groupby("k").cumcount()
    merged = gr.set_index("o")["i"].sort_index()
    np.testing.assert_array_equal(merged.to_numpy(),
                                  exp.reindex(pdf.sort_values("o").index).to_numpy())


def test_keyed_prefix_sum_hot_key(spark):
    df, pdf = skewed(spark)
    got = keyed_prefix_sum(df, "k", "o", ["v"], partitions=7).toPandas().sort_values(["k", "o"])
    exp = pdf.sort_values(["k", "o"]).groupby("k")["v"].cumsum()
    np.testing.assert_array_equal(got["v_cum"].to_numpy(), exp.to_numpy())


def test_null_groups_are_kept(spark):
    rows = [(None, 3, 1), (None, 1, 1), (1, 2, 5), (1, 0, 2), (None, 2, 1)]
    df = spark.createDataFrame(rows, "k LONG, o LONG, v LONG")
    r = {(x.k, x.o): x.i for x in row_index(df, order="o", group="k", index_col="i").collect()}
    assert r == {(None, 1): 0, (None, 2): 1, (None, 3): 2, (1, 0): 0, (1, 2): 1}
    c = {(x.k, x.o): x.v_cum for x in keyed_prefix_sum(df, "k", "o", ["v"]).collect()}
    assert c == {(None, 1): 1, (None, 2): 2, (None, 3): 3, (1, 0): 2, (1, 2): 7}


def test_following_row_over_partition_ends(spark):
    """The next row of a group, also where a range partition ends inside it."""
    df, pdf = skewed(spark, n=900)
    pdf = pdf.sort_values(["k", "o"])
    pdf["next"] = pdf.groupby("k")["v"].shift(-1)
    expect = sorted((int(a), int(b)) for a, b in pdf.dropna()[["v", "next"]].to_numpy())
    for partitions in (1, 7, 60):
        got = following(df, order="o", group="k", value="v", partitions=partitions).collect()
        assert sorted((r.value, r.next) for r in got) == expect


def test_following_row_with_nulls(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, None, 6), (2, 1, 7), (None, 1, 8), (None, 2, 9)],
                               "g LONG, o INT, v LONG")
    for partitions in (1, 5):
        got = following(df, order="o", group="g", value="v", partitions=partitions).collect()
        assert sorted((r.value, r.next) for r in got if r.value) == [(6, None)]
        assert [(r.value, r.next) for r in got if not r.value] == [(None, 5)]
