"""Session helpers: UTC, shared work folders, sizing for large inputs."""

from eventweave.session import checkpoint_root, scale_conf, work_dir


def test_session_is_utc_and_work_dirs_are_unique(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_scale_conf_for_100_tb():
    conf = scale_conf(100 * 2**40, cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == "40000"
    assert scale_conf(10 * 2**40, cores=800)["spark.sql.shuffle.partitions"] == str(2**40 // (256 << 20))
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
    assert int(scale_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"]) == 16   # at least 2x cores
