from cellar.session import CLUSTER_CONF, DEFAULT_CONF, ship_code, shared_path, shared_root


def test_shared_paths_live_under_the_checkpoint_folder(spark):
    root = shared_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or root).rstrip("/")
    p = shared_path(spark, "x", "y", unique=True)
    assert p.startswith(root + "/cellar/x/y/") and p != shared_path(spark, "x", "y", unique=True)


def test_ship_code_is_idempotent(spark):
    ship_code(spark)
    ship_code(spark)


def test_cluster_profile_keys_are_runtime_sql_settings(spark):
    for key in CLUSTER_CONF:
        assert spark.conf.isModifiable(key), key
    assert DEFAULT_CONF["spark.sql.session.timeZone"] == "UTC"
