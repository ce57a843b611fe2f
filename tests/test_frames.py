import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.errors import GuardFault, PairFault, VersionFault, ScanFault
from shardloom.functions.checks import frame_rules
from shardloom.operators import guard as g
from shardloom.operators import pairing as p
from shardloom.operators import sampling as sp
from shardloom.operators import splits as s
from shardloom.plans.incremental import ingest
from shardloom.schemas import FRAME
from shardloom.sources import shards


def frames(spark, subjects=4, samples=3, shard_of=lambda i: f"shard_{i % 2}"):
    rows = [
        (1, f"S{i:04d}", f"S{i:04d}_s{j:02d}", b"iris", b"print", i, "train", shard_of(i))
        for i in range(subjects)
        for j in range(samples)
    ]
    return spark.createDataFrame(rows, FRAME)


# --- splits ---------------------------------------------------------------------------------------


def _split_by_hand(n, test=0.05, val=0.15, at_least=0, keep_train=True):
    n_test, n_val = max(at_least, int(n * test)), max(at_least, int(n * val))
    while keep_train and n - n_test - n_val < 1 and n_test + n_val > 0:
        if n_val > 0:
            n_val -= 1
        else:
            n_test -= 1
    return ["test" if i < n_test else "val" if i < n_test + n_val else "train" for i in range(n)]


@pytest.mark.parametrize("shares", [{}, {"test": 0.5, "val": 0.5}, {"test": 0.9, "val": 0.3}, {"test": 0.0}])
def test_stratified_split_for_every_group_size(spark, shares):
    rows = [(f"g{n}", i) for n in range(1, 45) for i in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int")
    found = {(r.g, r.k): r.split for r in s.stratified(df, "g", ["k"], **shares).collect()}
    expected = {(f"g{n}", i): x for n in range(1, 45) for i, x in enumerate(_split_by_hand(n, **shares))}
    assert found == expected
    index = {(r.g, r.k): r.split for r in s.split_index(df, "g", ["k"], **shares).collect()}
    assert index == expected


def test_per_shard_split_has_test_and_val_rows(spark):
    df = spark.createDataFrame([(f"g{n}", i) for n in (1, 2, 3, 20, 41) for i in range(n)], "g string, k int")
    found = {(r.g, r.k): r.split for r in s.per_shard(df, "g", ["k"]).collect()}
    for n in (1, 2, 3, 20, 41):
        by_hand = _split_by_hand(n, at_least=1, keep_train=False)
        assert [found[f"g{n}", i] for i in range(n)] == by_hand


def test_split_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(40)] + [("a", 1)], "g string, k int")
    counts = {(r.g, r.split): r.n_rows for r in s.split_counts(s.stratified(df, "g", ["k"]), "g", "split").collect()}
    assert counts == {(None, "test"): 2, (None, "val"): 6, (None, "train"): 32, ("a", "train"): 1}


def test_labels_cover_all_subjects_in_sorted_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b10",), ("b2",)], "subject_id string")
    labels = s.encode_labels(df)
    assert {r.subject_id: r.label for r in labels.collect()} == {"a": 0, "b": 1, "b10": 2, "b2": 3, "c": 4}
    requested = df.filter("subject_id = 'c'")
    assert s.with_labels(requested, labels).first().label == 4
    assert s.num_classes(labels.filter("label <> 1")).first().asDict() == {"num_classes": 5, "distinct_labels": 4}


@pytest.mark.parametrize("subjects,shards_,sizes", [(10, 3, [3, 3, 4]), (4, 4, [1, 1, 1, 1]), (2, 4, [1, 1])])
def test_contiguous_shards(spark, subjects, shards_, sizes):
    df = spark.createDataFrame([(f"S{i:04d}",) for i in range(subjects)], "subject_id string")
    rows = sorted(s.assign_shards(df, shards_).collect(), key=lambda r: r.ordinal)
    index = [r.shard_index for r in rows]
    assert index == sorted(index)
    assert [index.count(i) for i in sorted(set(index))] == sizes


# --- sampling -------------------------------------------------------------------------------------


@pytest.mark.parametrize("n,world", [(10, 3), (9, 3), (2, 7), (1, 4)])
@pytest.mark.parametrize("drop_last", [False, True])
def test_sharded_index(spark, n, world, drop_last):
    df = spark.range(n)
    rows = sp.sharded_index(df, "id", world, shuffle=False, drop_last=drop_last).collect()
    order = list(range(n))
    per_rank = n // world if drop_last else -(-n // world)
    filled = (order * (world + 1))[: per_rank * world]
    for rank in range(world):
        mine = sorted((r.slot, r.id) for r in rows if r.rank == rank)
        assert [i for _, i in mine] == filled[rank :: world]
        assert [slot for slot, _ in mine] == list(range(per_rank))


def test_shuffle_depends_on_seed_plus_epoch_only(spark):
    def order(seed, epoch):
        rows = sp.sharded_index(spark.range(50).repartition(3), "id", 2, seed, epoch).collect()
        return [r.id for r in sorted(rows, key=lambda r: r.pos)]

    assert order(1, 2) == order(2, 1) == order(1, 2)
    assert order(1, 2) != order(1, 3)
    assert sorted(order(1, 2)) == list(range(50))


def test_batches(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(3)], "g string, k int")
    kept = sp.make_batches(df, ["k"], ["g"], 4).collect()
    assert {(r.g, r.k): (r.batch_id, r.slot) for r in kept}["a", 9] == (2, 1)
    assert len(kept) == 13
    full = sp.make_batches(df, ["k"], ["g"], 4, drop_last=True).collect()
    assert sorted((r.g, r.k) for r in full) == [("a", i) for i in range(8)]


def test_sampled_steps(spark):
    df = spark.range(205).select(F.lit("r").alias("run"), F.col("id").alias("step"))
    rows = sp.sample_steps(df, "run", "step").collect()
    by_kind = {k: sorted(r.step for r in rows if r.kind == k) for k in ("log", "checkpoint", "final")}
    assert by_kind == {"log": list(range(0, 205, 10)), "checkpoint": [100, 200], "final": [204]}


# --- pairing --------------------------------------------------------------------------------------


def listing(spark, *rows):
    return spark.createDataFrame([(a, b, b.encode()) for a, b in rows], "subject_id string, path string, content binary")


def test_pairing_and_missing(spark):
    iris = listing(spark, ("1", "i/1/b"), ("1", "i/1/a"), ("2", "i/2/a"), ("4", "i/4/a"))
    prints = listing(spark, ("1", "f/1/b-0/a"), ("1", "f/1/b/z"), ("2", "f/2/q"), ("3", "f/3/a"))
    pairs = {(r.iris_path, r.fingerprint_path, bytes(r.fingerprint_bytes)) for r in p.pair(iris, prints).collect()}
    assert pairs == {("i/1/a", "f/1/b/z", b"f/1/b/z"), ("i/1/b", "f/1/b/z", b"f/1/b/z"), ("i/2/a", "f/2/q", b"f/2/q")}
    assert sorted(r[0] for r in p.common_subjects(iris, prints).collect()) == ["1", "2"]
    folders = spark.createDataFrame([("5",), ("1",)], "subject_id string")
    missing = {tuple(r) for r in p.missing_modality(iris, prints, folders, "root/").collect()}
    assert missing == {
        ("3", "iris", "root/iris/3"), ("4", "fingerprint", "root/fingerprint/4"), ("5", "iris", "root/iris/5"),
    }
    with pytest.raises(PairFault) as caught:
        p.missing_modality(iris, prints, strict=True)
    assert (caught.value.subject_id, caught.value.modality) == ("3", "iris")


def test_pairing_with_a_hot_subject(spark):
    iris = spark.range(3000).select(
        F.lit("hot").alias("subject_id"), F.col("id").cast("string").alias("path"), F.lit(b"x").alias("content")
    )
    prints = iris.limit(1000)
    assert p.pair(iris, prints).count() == 3000


def test_missing_roots_and_shards(spark):
    media = spark.createDataFrame([("iris",), ("iris",)], "modality string")
    assert [r[0] for r in p.missing_roots(media).collect()] == ["fingerprint"]
    with pytest.raises(ScanFault):
        p.missing_roots(media, strict=True)
    wanted = spark.createDataFrame([("a",), ("x",), ("x",)], "shard_id string")
    have = spark.createDataFrame([("a",)], "shard_id string")
    assert [r[0] for r in p.shards_not_found(wanted, have).collect()] == ["x"]
    with pytest.raises(ScanFault) as caught:
        p.shards_not_found(wanted, have, "here", strict=True)
    assert caught.value.shard_id == "x"


# --- schema ---------------------------------------------------------------------------------------


def test_guard_checks_in_order(spark):
    good = frames(spark)
    assert g.guard(good) is good
    with pytest.raises(GuardFault, match="label: missing"):
        g.guard(good.drop("label").withColumn("schema_version", F.lit(9)))
    with pytest.raises(GuardFault, match="label: string, not bigint"):
        g.guard(good.withColumn("label", F.col("label").cast("string")))
    with pytest.raises(VersionFault) as caught:
        g.guard(good.withColumn("schema_version", F.lit(2)).withColumn("iris_bytes", F.lit(None).cast("binary")))
    assert caught.value.found == 2
    with pytest.raises(GuardFault, match="12 null.s. in iris_bytes"):
        g.guard(good.withColumn("iris_bytes", F.lit(None).cast("binary")))
    empty = good.withColumn("iris_bytes", F.lit(b""))
    assert g.guard(empty) is empty
    found = {r.check_name: r.found for r in g.table_checks(empty).collect()}
    assert found["empty_iris_bytes"] == 12 and found["null_iris_bytes"] == 0


def test_upcast_one_version_at_a_time(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "schema_version int, x string")
    steps = {
        2: lambda col: {"x": F.concat(col("x"), F.lit("2"))},
        1: lambda col: {"x": F.concat(col("x"), F.lit("1")), "added": F.lit(True)},
    }
    rows = {r.x: (r.schema_version, r.added) for r in g.upcast(df, steps).collect()}
    assert rows == {"a12": (3, True), "b2": (3, None), "c": (3, None), "d12": (3, True)}
    assert g.upcast(df, {}).filter("schema_version is null").count() == 0
    with pytest.raises(VersionFault):
        g.too_new(df, 2, strict=True)
    assert g.too_new(df, 2).count() == 1


def test_rows_are_separated_by_rules(spark):
    df = frames(spark, 2, 1).unionByName(
        spark.createDataFrame([(0, "S", None, b"", b"x", -1, "dev", "s")], FRAME)
    )
    valid, broken = g.separate(df, frame_rules())
    assert valid.count() == 2
    assert broken.first().violations == ["schema_version", "sample_id", "iris_bytes", "label", "split"]


# --- shards on disk ---------------------------------------------------------------------------------


def test_shards_are_written_listed_and_scanned(spark, tmp_path):
    root = str(tmp_path / "frames")
    df = frames(spark, 10, 3)
    assert shards.write_shards(df, root) == 30
    listed = shards.list_shards(spark, root)
    assert [r[0] for r in listed.collect()] == ["shard_0", "shard_1"]
    wanted = spark.createDataFrame([("shard_1",)], "shard_id string")
    part = shards.scan(spark, root, wanted, strict=True)
    assert part.schema.fieldNames() == FRAME.fieldNames()
    assert part.count() == 15 and {r.label % 2 for r in part.collect()} == {1}
    assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ScanFault):
        shards.scan(spark, root, spark.createDataFrame([("nope",)], "shard_id string"), strict=True)
    # Present shards are kept, absent ones are added.
    more = frames(spark, 3, 1, lambda i: f"shard_{i}")
    assert shards.write_missing(more, root, listed) == 1
    assert [r[0] for r in shards.list_shards(spark, root).collect()] == ["shard_0", "shard_1", "shard_2"]
    assert [r[0] for r in shards.keys_with_prefix(listed, "shard_1").collect()] == ["shard_1"]
    assert shards.existing(wanted, listed).count() == 1


def test_flat_shard_files(spark, tmp_path):
    import pyarrow.parquet as pq

    table = frames(spark, 2, 2).toArrow()
    for name in ("b", "a"):
        pq.write_table(table, tmp_path / f"{name}.parquet")
    root = str(tmp_path)
    assert [r[0] for r in shards.list_shards(spark, root).collect()] == ["a", "b"]
    assert shards.scan_files(spark, root, ["a", "b"]).count() == 8
    assert shards.scan_files(spark, root, []).schema == FRAME
    with pytest.raises(ScanFault):
        shards.scan_files(spark, root, ["a", "nonexistent_shard"])


def test_built_frames_follow_the_schema(spark):
    df = spark.createDataFrame([("S", "x", b"i", b"f", 3)], "subject_id string, sample_id string, iris_bytes binary, fingerprint_bytes binary, label int")
    row = shards.build_frames(df)
    assert [(f.name, f.dataType) for f in row.schema] == [(f.name, f.dataType) for f in FRAME]
    assert row.schema["schema_version"].metadata["schema_name"] == "Frame"
    assert (row.first().split, row.first().schema_version, row.first().source_shard) == ("train", 1, "")
    assert shards.union_shards(row, row).count() == 2


def test_ingest_run(spark):
    from test_manifest import append

    from shardloom.operators import manifest as m

    log = append(spark, m.empty_log(spark), ("shard_0", "ADD"), ("shard_1", "ADD"), ("shard_1", "COMMIT"))
    df = frames(spark, 10, 20)
    run = ingest(log, df)
    assert [r.shard_id for r in run.planned.collect()] == ["shard_0"]
    counts = {r.split: r.n_rows for r in s.split_counts(run.frames).collect()}
    assert counts == {"test": 5, "val": 15, "train": 80}
    assert [(r.shard_id, r.operation) for r in run.commit.collect()] == [("shard_0", "COMMIT")]
    with pytest.raises(GuardFault):
        ingest(log, df.withColumn("iris_bytes", F.lit(None).cast("binary")))


@given(st.lists(st.sampled_from(["int", "string", "binary"]), min_size=0, max_size=4))
def test_schema_differences_name_every_column(kinds):
    types = {"int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType()}
    actual = T.StructType([T.StructField(f.name, types[k]) for f, k in zip(FRAME.fields, kinds, strict=False)])
    problems = dict(g.schema_differences(actual))
    for at, field in enumerate(FRAME.fields):
        if at >= len(kinds):
            assert problems[field.name] == "missing"
        else:
            assert (field.name in problems) == (types[kinds[at]] != field.dataType)
