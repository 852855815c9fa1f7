"""Where tables are staged."""

import pytest

from resultlake import session


class Named:
    """A session whose settings are these, on the files of the real one."""

    def __init__(self, spark, **settings):
        self.sparkContext, self._settings, self.conf = spark.sparkContext, settings, self

    def get(self, name, default=None):
        return self._settings.get(name.replace(".", "_"), default)


def test_named_folder_is_taken(spark):
    named = Named(spark, spark_master="yarn", spark_checkpoint_dir="file:///shared/")
    assert session.stage_root(named) == "file:///shared"


def test_local_warehouse_is_refused_on_a_cluster(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.stage_root(Named(spark, spark_master="yarn", spark_sql_warehouse_dir="/tmp/warehouse"))
    alone = Named(spark, spark_master="local[8]", spark_sql_warehouse_dir="/tmp/warehouse/")
    assert session.stage_root(alone) == "/tmp/warehouse"
