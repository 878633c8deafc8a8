import random

import pytest
from pyspark.sql import functions as F

from closebook.llm.common import measured
from closebook.llm.components import components, merged


def plain(edges):
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {x: low if r == high else r for x, r in root.items()}
    return root


def read(frame):
    rows = [(r.id, r.component) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return dict(rows)


@pytest.fixture
def jobs(spark):
    """How many jobs were run by what it is given."""

    def count(work):
        tracker, name = spark.sparkContext.statusTracker(), f"jobs-{random.random()}"
        spark.sparkContext.setJobGroup(name, name)
        work()
        return len(tracker.getJobIdsForGroup(name))

    yield count
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_components_grow_with_edges(spark):
    """Edges in parts, one of them of pairs already joined and loops, give the components of all edges."""
    draws, comps, every = random.Random(1), None, []
    for part in range(3):
        edges = [(draws.randrange(150), draws.randrange(150)) for _ in range(40)]
        edges = [e for e in edges if e[0] != e[1]] if part != 1 else [(b, a) for a, b in every[:20]]
        every += edges
        comps = merged(comps, spark.createDataFrame(edges + [(7, 7)], "a long, b long"))
        assert read(comps) == plain(every)


def test_nothing_new_runs_no_rounds(spark, jobs):
    """The driver's threads grow with the jobs and shuffles of all rounds, so that none is run for nothing."""
    comps = merged(None, spark.createDataFrame([(1, 2), (2, 3), (8, 9)], "a long, b long"))
    more = spark.createDataFrame([(1, 3), (9, 8)], "a long, b long")
    assert jobs(lambda: components(more)) > 2 * jobs(lambda: merged(comps, more))
    assert merged(comps, more) is comps
    assert components(more.where("false")).count() == 0


def test_figures_of_what_is_stored(spark):
    frame = spark.range(10)
    for rows, n, total in ((frame, 10, 45), (frame.where("id > 20"), 0, None), (frame.where("false"), 0, None)):
        kept, seen = measured(rows, "measured", n=F.count("*"), total=F.sum("id"))
        assert seen == {"n": n, "total": total} and kept.count() == n
