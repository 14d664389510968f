from tidemark.session import apply_settings, scale_settings, scratch_path, shared_dir


def test_scale_settings_sizes_shuffle_for_volume():
    small = scale_settings(1 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_settings(20 * (1 << 40))
    assert big["spark.sql.shuffle.partitions"] == str(20 * (1 << 40) // (256 << 20)) == "81920"
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "81920"


def test_shared_folder_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_apply_settings_runtime(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    apply_settings(spark, {"spark.sql.files.maxPartitionBytes": "134217728"})
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728"
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest
    from tidemark import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k: (_ for _ in ()).throw(KeyError(k)))})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
