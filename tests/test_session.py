"""Session defaults yield to the cluster's settings; explicit arguments win."""

from chargepulse.session import SQL_DEFAULTS, checkpoint_root, get_session, work_dir
from chargepulse.streaming.jobs import console, run_to_end

from conftest import SF001


def test_defaults_and_explicit_settings(spark):
    s = get_session(shuffle_partitions=8)
    assert s is spark
    assert s.conf.get("spark.sql.shuffle.partitions") == "8"
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    for k in SQL_DEFAULTS:
        assert s.conf.get(k, None) is not None


def test_work_dirs_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark).rstrip("/")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_console_sink_runs(spark):
    from chargepulse.plans.catalog import rlog
    from chargepulse.sources.files import read_lines_stream, stage_lines
    root = work_dir(spark, "test-console")
    stage_lines(rlog(spark, SF001), f"{root}/src", files=2)
    run_to_end(console(read_lines_stream(spark, f"{root}/src", 1), trigger="availableNow", rows=2), 300)
