import os

from closebook import workspace


def test_store_and_clear(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_created", [])
    stored = workspace.store(spark.range(5).selectExpr("id", "cast(id as decimal(38,2)) as amount"), "numbers")
    assert stored.count() == 5
    path = workspace._created[0]
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert os.path.exists(path)
    workspace.clear(spark)
    assert not os.path.exists(path)


class Elsewhere:
    """A session without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "s3a://lake/warehouse/" if key == "spark.sql.warehouse.dir" else default


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    assert workspace.folder(Elsewhere()) == "s3a://lake/warehouse"
