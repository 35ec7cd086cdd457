"""Encoding of columns with very many levels."""

import subprocess
import sys
import textwrap

from conftest import ROOT
from scorespark.operators.preparing import fit_sparse_onehot

_MILLION = textwrap.dedent(
    """
    from pyspark.sql import functions as F
    from scorespark.operators.preparing import fit_sparse_onehot
    from scorespark.session import spark_session

    spark = spark_session("levels", "local[2]", **{"spark.ui.enabled": "false", "spark.driver.memory": "1g", "spark.sql.shuffle.partitions": "16"})
    df = spark.range(1_200_000).select(F.format_string("level %08d", F.pmod("id", F.lit(1_000_000))).alias("a"))
    model = fit_sparse_onehot(df, ["a"], fit_on="all")
    rows = model.transform(df.where("a < 'level 00000003'")).collect()
    print(model.sizes[0], sorted((r.a[-1], r.onehot.size, tuple(map(int, r.onehot.indices))) for r in rows))
    spark.stop()
    """
)


def test_numbers_follow_the_order_of_levels(spark):
    rows = [("b", 2, None), ("a", 1, "x"), ("c", 3, "x"), (None, None, None), ("b", 2, "x")] * 30
    df = spark.createDataFrame(rows, "a string, b int, only string")
    model = fit_sparse_onehot(df, ["a", "b", "only"], fit_on="all")
    assert model.sizes == (3, 3, 1)
    found = {(r.a, r.b): tuple(map(float, r.onehot.toArray())) for r in model.transform(df).collect()}
    assert found == {
        ("a", 1): (0, 0, 0, 0, 0, 0, 0),
        ("b", 2): (0, 1, 0, 0, 1, 0, 0),
        ("c", 3): (0, 0, 1, 0, 0, 1, 0),
        (None, None): (0, 0, 0, 0, 0, 0, 0),
    }
    unseen = spark.createDataFrame([("z", 3, "y")], "a string, b int, only string")
    assert tuple(model.transform(unseen).first().onehot.toArray()) == (0, 0, 0, 0, 0, 1, 0)
    assert model.transform(df).count() == len(rows)


def test_a_million_levels_under_a_small_driver():
    done = subprocess.run([sys.executable, "-c", _MILLION], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("1000000 [('0', 1000000, ()), ('0', 1000000, ()), ('1', 1000000, (1,)), ('1', 1000000, (1,)), ('2', 1000000, (2,)), ('2', 1000000, (2,))]"), done.stderr[-2000:]
