"""Session construction rules."""

from estatelens.session import DEFAULT_CONF, cluster_conf, _master_configured, ensure_checkpoint_dir, get_spark


def test_explicit_settings_apply_to_a_reused_session(spark):
    s = get_spark(shuffle_partitions=5)
    try:
        assert s is spark
        assert s.conf.get("spark.sql.shuffle.partitions") == "5"
        assert s.conf.get("spark.sql.adaptive.enabled") == "true"
        assert s.conf.get("spark.sql.session.timeZone") == DEFAULT_CONF["spark.sql.session.timeZone"]
    finally:
        s.conf.set("spark.sql.shuffle.partitions", "4")


def test_launcher_decides_the_master(monkeypatch):
    monkeypatch.setenv("PYSPARK_GATEWAY_PORT", "1")
    assert _master_configured()


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark, fallback="/should/not/be/used")
    assert d and d != "/should/not/be/used"


def test_shuffle_sizing_reaches_the_session(spark):
    """Keys the launcher set stay; the others get the size of the shuffle."""
    size = 50 * 256 * 1024 * 1024
    want = cluster_conf(size, spark.sparkContext.defaultParallelism)
    before = {k: spark.conf.get(k, None) for k in want}
    submitted = spark.sparkContext.getConf()
    try:
        get_spark(largest_shuffle_bytes=size)
        free = [k for k in want if not submitted.contains(k)]
        assert free and all(spark.conf.get(k) == want[k] for k in free)
        assert want["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "50"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
