"""The shared folder: taken from the session, refused where a cluster has none."""

from types import SimpleNamespace

import pytest

from airshed import session


def fake(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, applicationId="app-test",
                              getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf={"spark.checkpoint.dir": conf} if conf else {},
                           sparkContext=context)


def test_setting_comes_first():
    assert session.shared_folder(fake("spark://m:7077", "hdfs://x/y/", "hdfs://z")) == "hdfs://x/y"


def test_folder_of_the_context_counts():
    assert session.shared_folder(fake("yarn", None, "hdfs://z")) == "hdfs://z"


@pytest.mark.parametrize("master", ["yarn", "spark://m:7077", "local-cluster[2,1,1024]"])
def test_cluster_without_folder_is_refused(master):
    with pytest.raises(RuntimeError):
        session.shared_folder(fake(master))


def test_scratch_is_new_each_time(spark):
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_kept_rows_come_back(spark):
    assert session.kept(spark.range(5), "kept").count() == 5
