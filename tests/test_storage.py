import pytest

from cargolens import storage


def test_scratch_tables_lie_together_and_go_together(spark):
    df = storage.stored(spark.range(10), "numbers")
    assert df.count() == 10
    root = storage.scratch_root(spark)
    assert storage.path_exists(spark, root) and spark.sparkContext.applicationId in root
    storage.remove_path(spark, root)
    assert not storage.path_exists(spark, root)
    storage.remove_path(spark, root)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session())
