import pytest

from listingloom import storage


def test_stage_writes_below_the_shared_folder(spark):
    staged = storage.stage(spark.range(5), "numbers")
    (path,) = {f.rsplit("/", 2)[0] for f in staged.inputFiles()}
    assert path.removeprefix("file://") == spark.conf.get("spark.checkpoint.dir")
    assert staged.count() == 5


class _Session:
    """A session without the setting, on the given master."""

    def __init__(self, master):
        self.conf = type("conf", (), {"get": staticmethod(lambda key, default: default)})
        self.sparkContext = type("context", (), {"master": master, "applicationId": master})


def test_cluster_needs_the_setting():
    assert storage.work_dir(_Session("local[2]"), "x") != storage.work_dir(_Session("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.work_dir(_Session("spark://host:7077"), "x")


def test_temporary_stages_go(spark):
    from pathlib import Path

    with storage.temporary_stages(spark):
        staged = storage.stage(spark.range(5), "gone")
        (path,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in staged.inputFiles()}
        assert Path(path).exists()
    assert not Path(path).exists()


def test_shuffle_files_go_with_the_write(spark):
    """A plan of many stored tables holds the shuffles of one write, not of all."""
    import time
    from pathlib import Path

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {file.name for folder in folders for file in Path(folder).rglob("shuffle_*.data")}

    before, setting = shuffled(), spark.conf.get(storage.CLEANUP_KEY, None)
    stored = storage.stage(spark.range(1000).repartition(3).selectExpr("id % 7 AS k").groupBy("k").count(), "counted")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(storage.CLEANUP_KEY, None) == setting
    assert stored.count() == 7 and ".zstd." in stored.inputFiles()[0]
