from vertexrank.session import checkpoint_dir, path_exists, scratch_path, sql_conf


def test_sql_conf_restores_values(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sql_conf(spark, {key: "3", "spark.sql.adaptive.enabled": "false"}):
        assert spark.conf.get(key) == "3"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    assert spark.conf.get(key) == before


def test_sql_conf_restores_on_error(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        with sql_conf(spark, {key: "5"}):
            raise RuntimeError("boom")
    except RuntimeError:
        pass
    assert spark.conf.get(key) == before


def test_checkpoint_dir_is_the_sessions(spark):
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/") + "/x-")


def test_checkpoint_folder_defaults_to_the_warehouse(spark):
    import inspect

    from vertexrank import session

    assert "tempfile" not in inspect.getsource(session)
    assert path_exists(spark, checkpoint_dir(spark))
