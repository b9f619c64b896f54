"""Hot keys: one IP carries a third of all sessions, one player a third of
the sessions too. Results must equal a brute-force computation, with AQE's
skew-join split forced by tiny thresholds."""

from collections import defaultdict

from pyspark.sql import functions as F

from riskmesh.operators import gold


def test_hot_ip_and_hot_player(spark):
    n = 30000
    df = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot-player"))
         .otherwise(F.concat(F.lit("p"), (F.col("id") % 997).cast("string"))).alias("player_id"),
        F.when(F.col("id") % 3 == 1, F.lit("10.0.0.1"))
         .when(F.col("id") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("ip"), (F.col("id") % 50).cast("string"))).alias("ip"),
        F.element_at(F.array(F.lit("web"), F.lit("mobile"), F.lit("tv")),
                     (F.col("id") % 3 + 1).cast("int")).alias("device"),
        F.timestamp_seconds(F.col("id")).alias("session_at"),
    ).repartition(16)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.player_id: r for r in gold.session_features(df).join(
            gold.ip_risk(df), "player_id", "left").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

    rows = df.collect()
    players_on_ip, ips, devices, count = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(int)
    for r in rows:
        count[r.player_id] += 1
        devices[r.player_id].add(r.device)
        if r.ip is not None:
            players_on_ip[r.ip].add(r.player_id)
            ips[r.player_id].add(r.ip)
    for p, r in got.items():
        assert r.session_count == count[p]
        assert r.distinct_ip_count == len(ips[p])
        assert r.distinct_device_count == len(devices[p])
        expected = max((len(players_on_ip[i]) for i in ips[p]), default=None)
        assert r.max_players_on_same_ip == expected
    assert set(got) == set(count)
    assert got["hot-player"].session_count == n // 3


def test_salted_join_spreads_hot_and_null_keys(spark):
    from riskmesh.operators.salting import salted_join
    from pyspark.sql import functions as F
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        n = 9000
        many = spark.range(n).select(F.col("id").alias("player_id"),
                                     F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("ip"))
        one = many.where("ip is not null").groupBy("ip").agg(F.count("*").alias("n"))
        joined = salted_join(many, one, "ip", "left", ["player_id"])
        assert joined.count() == n and joined.where("ip is null and n is not null").count() == 0
        assert joined.where("ip = 'hot' and n = 3000").count() == 3000
        for which in ("ip = 'hot'", "ip is null"):
            per_task = [r["count"] for r in joined.where(which).groupBy(F.spark_partition_id()).count().collect()]
            assert len(per_task) >= 6 and max(per_task) < 1500, per_task
        missing = salted_join(many.where("ip is not null"), one.where("ip <> 'hot'"), "ip", "left_anti", ["player_id"])
        assert missing.count() == 3000 and max(r["count"] for r in missing.groupBy(F.spark_partition_id()).count().collect()) < 1500
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_hot_keys_are_copied(spark):
    from riskmesh.operators.salting import SALTS, heavy_hitters, salted_sides
    even = spark.range(20000).select(F.col("id").alias("player_id"), (F.col("id") % 5000).cast("string").alias("ip"))
    one = even.groupBy("ip").agg(F.count("*").alias("n"))
    left, right = salted_sides(even, one, "ip", ["player_id"])
    assert right.count() == one.count() == 5000 and left.where("_salt <> 0").count() == 0
    skewed = even.unionAll(spark.range(9000).select(F.col("id"), F.lit("proxy"))).unionAll(spark.range(2000).select(F.col("id"), F.lit(None).cast("string")))
    one = skewed.where("ip is not null").groupBy("ip").agg(F.count("*").alias("n"))
    left, right = salted_sides(skewed, one, "ip", ["player_id"])
    assert right.count() == 5001 + SALTS - 1 and left.where("ip = 'proxy'").select("_salt").distinct().count() == SALTS
    assert left.where("ip <> 'proxy' and _salt <> 0").count() == 0 and left.where("ip is null").select("_salt").distinct().count() > 1000
    assert [r.ip for r in heavy_hitters(skewed, "ip").collect()] == ["proxy"]


def test_heavy_hitters_miss_no_hot_key(spark):
    from riskmesh.operators.salting import heavy_hitters
    # 200 keys just above the share among many rare ones, over several tasks
    n = 120_000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, (F.col("id") / 2 % 100).cast("int").cast("string"))
                               .otherwise(F.concat(F.lit("r"), F.col("id").cast("string"))).alias("k")).repartition(13)
    found = {r.k for r in heavy_hitters(df, "k").collect()}
    assert {str(i) for i in range(100)} <= found and len(found) <= 512
    assert heavy_hitters(df.limit(0), "k").count() == 0
