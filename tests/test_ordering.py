import random

from pyspark.sql import functions as F

from shardloom.operators.ordering import neighbour, positions


def test_positions_with_a_hot_and_a_null_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i) for i in rng.sample(range(5000), 3000)]
    placed = positions(spark.createDataFrame(rows, "g string, k int"), ["k"], ["g"], partitions=7)
    expected = {}
    for group in {g for g, _ in rows}:
        keys = sorted(k for g, k in rows if g == group)
        expected.update({(group, k): (i, len(keys)) for i, k in enumerate(keys)})
    assert {(r.g, r.k): (r.pos, r.n) for r in placed.collect()} == expected


def test_a_hot_group_is_spread_over_partitions(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), "id")
    placed = positions(df, ["id"], ["g"], partitions=8)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000
    assert placed.filter("pos != id").count() == 0


def test_global_positions_and_empty_input(spark):
    placed = positions(spark.range(100).withColumn("id", 99 - F.col("id")), ["id"])
    assert placed.filter("pos != id or n != 100").count() == 0
    assert positions(spark.range(0), ["id"]).count() == 0


def test_neighbour_equals_a_plain_window(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice(["hot", "hot", "b", None]), rng.randrange(500), i, rng.choice([None, 1, 2]))
        for i in range(800)
    ]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int")
    for following, hot in ((False, 1), (True, 1), (True, 300), (False, 10**6)):
        bucket = F.floor(F.col("t") / 40)
        found = neighbour(df, ["k"], "t", "i", F.col("v"), bucket, "x", following, hot, 1.0)
        expected = {}
        for key in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
            for at, row in enumerate(own):
                other = at + 1 if following else at - 1
                expected[row[2]] = own[other][3] if 0 <= other < len(own) else None
        assert found.columns == ["k", "t", "i", "v", "x"]
        assert {r.i: r.x for r in found.collect()} == expected


def test_empty_inputs_are_counted(spark):
    from shardloom.session import counted, measured, weighed

    nothing = spark.createDataFrame([], "g string, k int, b binary")
    for df in (nothing, nothing.filter("false"), nothing.limit(0), spark.range(5).filter("id > 9")):
        assert counted(df)[1] == 0 and measured(df).count() == 0
    assert weighed(nothing, "b")[1:] == (0, 0)
    assert positions(nothing.select("g", "k"), ["k"], ["g"]).count() == 0
    some = spark.createDataFrame([(b"abc",), (None,)], "b binary")
    assert weighed(some, "b")[1:] == (2, 3)
    found = neighbour(nothing.select("g", "k"), ["g"], "k", "k", F.col("k"), F.col("k"), "x", hot_rows=1, sample=1.0)
    assert found.count() == 0
