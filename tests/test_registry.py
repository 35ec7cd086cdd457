"""Numbers are given once, also to processes that ask at the same time."""

import subprocess
import sys
import textwrap

import pytest

from conftest import ROOT
from scorespark.operators.scorecard import FROZEN_MODEL
from scorespark.sources import registry
from scorespark.sources.commits import create_once, names, read_once

_REGISTER = textwrap.dedent(
    """
    import sys
    from scorespark.operators.scorecard import FROZEN_MODEL
    from scorespark.session import spark_session
    from scorespark.sources import registry

    spark = spark_session("register", "local[2]", **{"spark.ui.enabled": "false", "spark.driver.memory": "1g"})
    print(*[registry.register_model(FROZEN_MODEL, sys.argv[1], 0.7, 0.3, sys.argv[2]) for _ in range(20)])
    spark.stop()
    """
)


def test_files_are_made_once(spark, tmp_path):
    path = f"{tmp_path}/a/b"
    assert create_once(spark, path, "first") and not create_once(spark, path, "second")
    assert read_once(spark, path) == "first" and read_once(spark, f"{tmp_path}/a/c") is None
    assert names(spark, f"{tmp_path}/a") == ["b"] and names(spark, f"{tmp_path}/none") == []


def test_two_processes_register_side_by_side(spark, tmp_path):
    root = str(tmp_path / "models")
    registry.reserve_version(spark, root)  # an attempt that broke off
    workers = [
        subprocess.Popen([sys.executable, "-c", _REGISTER, root, name], cwd=ROOT, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
        for name in "ab"
    ]
    given = [int(n) for w in workers for n in w.communicate(timeout=300)[0].split()]
    assert len(set(given)) == len(given) == 40 and 1 not in given
    assert sorted(r.version for r in registry.versions(spark, root).collect()) == sorted(given)


def test_a_reserved_number_is_committed_once(spark, tmp_path):
    root = str(tmp_path / "models")
    number = registry.reserve_version(spark, root)
    for auc in (0.7, 0.8):  # the second attempt finds the version committed
        assert registry.register_model(FROZEN_MODEL, root, auc, 0.3, "h", number=number) == number
    assert [r.auc for r in registry.versions(spark, root).collect()] == [0.7]
    registry.promote(spark, root, number)
    assert registry.load_current(spark, root) == FROZEN_MODEL
    with pytest.raises(LookupError):
        registry.load_version(spark, root, 99)


def test_going_back_is_a_promotion(spark, tmp_path):
    root = str(tmp_path / "models")
    for auc in (0.7, 0.8):
        registry.register_model(FROZEN_MODEL, root, auc, 0.3, "h")
    for version in (1, 2, 1):
        registry.promote(spark, root, version)
    assert registry.promoted_version(spark, root) == 1 and registry.promotions(spark, root).count() == 3
