import json
import os

from cartwise.session import checkpoint_dir, cluster_conf
from tests.conftest import SF_SMALL


def test_cluster_conf_sizes_partitions():
    small = cluster_conf(10 << 20, 64)
    assert small["spark.sql.shuffle.partitions"] == "128"  # at least 2x cores
    big = cluster_conf(10 << 40, 64)
    assert int(big["spark.sql.shuffle.partitions"]) == (10 << 40) // (256 << 20)
    huge = cluster_conf(100 * 10 ** 12, 8000)
    assert int(huge["spark.sql.shuffle.partitions"]) == -(-100 * 10 ** 12 // (256 << 20))
    assert huge["spark.sql.adaptive.enabled"] == "true"


def test_checkpoint_dir_is_stable(spark):
    a = checkpoint_dir(spark)
    assert a and checkpoint_dir(spark) == a


def test_cli_build_then_evaluate(spark, tmp_path, capsys):
    from cartwise.__main__ import main

    out = str(tmp_path / "run")
    main(["build", "--testdata", SF_SMALL, "--out", out, "--gbt-iter", "3",
          "--master", "local[4]"])
    (run,) = os.listdir(os.path.join(out, "runs"))
    assert {"test_set", "model_lr", "model_gbt"} == set(os.listdir(os.path.join(out, "runs", run)))
    capsys.readouterr()
    main(["evaluate", "--out", out, "--master", "local[4]"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(res) == {"lr", "gbt", "importance"}
    assert len(res["importance"]) == 18
    assert 0.0 <= res["gbt"]["f1_adjusted"] <= 1.0
