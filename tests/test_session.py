import pytest

from hourglass import session
from hourglass.session import (
    delete_folder, ensure_checkpoint_dir, list_names, path_exists, read_json, work_dir, write_json,
)


def test_checkpoint_dir_is_read_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    d = ensure_checkpoint_dir(spark)
    assert d and (named is None or d == named)      # never replaced once named
    assert ensure_checkpoint_dir(spark) == d
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(d.rstrip("/") + "/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_no_local_scratch_on_a_cluster(master):
    class Context:
        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()
        conf = {}

    Cluster.sparkContext.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())
    assert not hasattr(session, "apply_planning_conf")


def test_small_files(spark, workdir):
    path = f"{workdir}/a/_v-1.json"
    assert read_json(spark, path) is None and list_names(spark, f"{workdir}/a") == []
    write_json(spark, path, {"k": [1, "é"]})
    assert read_json(spark, path) == {"k": [1, "é"]} and path_exists(spark, path)
    with pytest.raises(RuntimeError, match="exists already"):
        write_json(spark, path, {})
    assert [n for n in list_names(spark, f"{workdir}/a") if not n.endswith(".crc")] == ["_v-1.json"]
    delete_folder(spark, f"{workdir}/a")
    assert not path_exists(spark, f"{workdir}/a")


def test_paths_without_scheme_mean_the_default_filesystem(spark, workdir):
    """A scheme-less path is looked up where Spark's readers look, not on the local disk."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    spark.range(3).write.parquet(f"{workdir}/data/x")
    local = workdir.removeprefix("file:")
    conf.set("fs.viewfs.mounttable.hg.link./data", f"file://{local}/data")
    conf.set("fs.defaultFS", "viewfs://hg/")
    try:
        assert path_exists(spark, "/data/x") and path_exists(spark, "/data/x/_SUCCESS")
        assert not path_exists(spark, "/data/y")
        assert path_exists(spark, f"file://{local}/data/x")
    finally:
        conf.set("fs.defaultFS", old or "file:///")
