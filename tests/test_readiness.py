from datetime import datetime, timedelta

from closebook.operators.readiness import report_readiness, source_freshness

NOW = datetime(2024, 1, 25, 12)
SCHEMA = "job_name string, run_id bigint, state string, started_on timestamp_ntz, completed_on timestamp_ntz"


def runs(spark, *rows):
    """(job, state, hours since the start, hours since completion or None)"""
    return spark.createDataFrame(
        [
            (job, i, state, NOW - timedelta(hours=begun), None if done is None else NOW - timedelta(hours=done))
            for i, (job, state, begun, done) in enumerate(rows)
        ],
        SCHEMA,
    )


def fresh(df):
    return {r.job_name: r.fresh for r in source_freshness(df, NOW).collect()}


def test_success_within_the_window(spark):
    df = runs(spark, ("new", "SUCCEEDED", 3, 2), ("old", "SUCCEEDED", 26, 25), ("edge", "SUCCEEDED", 25, 24))
    assert fresh(df) == {"new": True, "old": False, "edge": False}


def test_other_states_do_not_count(spark):
    df = runs(spark, ("a", "FAILED", 3, 2), ("b", "RUNNING", 3, None), ("c", "SUCCEEDED", 3, None), ("d", None, 3, 2))
    assert fresh(df) == {"a": False, "b": False, "c": False, "d": False}


def test_only_the_latest_runs_are_seen(spark):
    failures = [("a", "FAILED", h, h) for h in range(1, 6)]
    assert fresh(runs(spark, *failures, ("a", "SUCCEEDED", 6, 6))) == {"a": False}
    assert fresh(runs(spark, *failures[:4], ("a", "SUCCEEDED", 6, 6))) == {"a": True}


def test_later_runs_and_later_ends_are_unknown(spark):
    df = runs(spark, ("later", "SUCCEEDED", -1, -2), ("running", "SUCCEEDED", 1, -1))
    assert fresh(df) == {"running": False}


def test_last_success(spark):
    df = runs(spark, ("a", "SUCCEEDED", 30, 29), ("a", "SUCCEEDED", 40, 39), ("a", "FAILED", 2, 1))
    assert source_freshness(df, NOW).first().last_success == NOW - timedelta(hours=29)


def test_reports(spark):
    df = runs(spark, ("a", "SUCCEEDED", 3, 2), ("b", "FAILED", 3, 2))
    needs = {"both": ["a", "b"], "one": ["a"], "unknown": ["a", "never-ran"], "none": []}
    found = {r.report: (r.n_sources, r.n_stale, r.ready) for r in report_readiness(df, needs, NOW).collect()}
    assert found == {"both": (2, 1, False), "one": (1, 0, True), "unknown": (2, 1, False), "none": (0, 0, True)}
