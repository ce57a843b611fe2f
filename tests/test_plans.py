"""A small dataset through the whole life cycle."""

import base64

import numpy as np
from pyspark.sql import functions as F

from shardloom.functions import checks, pixels
from shardloom.functions.hashing import json_text
from shardloom.operators import guard, registry
from shardloom.plans import serving, training
from shardloom.schemas import FRAME, REQUEST
from shardloom.sources.log import write_provenance

SIZES = {"iris_size": (8, 8), "fingerprint_size": (12, 12)}


def test_train_register_and_serve(spark, tmp_path):
    rng = np.random.default_rng(8)
    faces = rng.integers(0, 256, (3, 64, 64))
    prints = rng.integers(0, 256, (3, 96, 96))

    def media(label):
        noise = rng.integers(-20, 20, (64, 64))
        return pixels.write_png(np.clip(faces[label] + noise, 0, 255)), pixels.write_png(prints[label])

    rows = [
        (1, f"S{i % 3:04d}", f"x{i:02d}", *media(i % 3), i % 3, "val" if i % 5 == 0 else "train", "s") for i in range(30)
    ]
    rows.append((1, "S0000", "bad", b"junk", rows[0][4], 0, "train", "s"))
    rows.append((1, "S0000", "ignored", b"junk", b"junk", 0, "test", "s"))
    run = training.train(
        spark.createDataFrame(rows, FRAME), "run1", "0f1e2d3c",
        F.create_map(F.lit("name"), json_text(F.lit("late_fusion"))), F.lit(7), max_steps=20, **SIZES,
    )
    manifest = run.manifest.first()
    assert manifest.num_classes == 3 and manifest.delta_log_offset == 7
    assert float(manifest.extra_tags["val_accuracy"]) == 1.0 and manifest.best_val_loss < 0.5
    assert [(r.sample_id, r.error.split(":")[0]) for r in run.rejected.collect()] == [("bad", "iris unreadable")]
    assert guard.separate(run.manifest, checks.run_rules())[1].count() == 0
    write_provenance(run.manifest, str(tmp_path / "run"))

    table = registry.register(run.manifest.withColumn("name", F.col("model_name")), "run_id")
    uri = registry.latest_uri(table, "late_fusion")
    assert uri == "models:/late_fusion/1" and registry.find(table, uri).run_id == "run1"

    def text(raw):
        return base64.b64encode(raw).decode()

    asked = [(1, f"q{i}", *map(text, media(i)), 2) for i in range(3)]
    asked += [(1, "broken", "!", text(b"x"), 11), (1, "empty", "", text(b"x"), 1), (1, "junk", *map(text, (b"x", b"y")), 1)]
    names = spark.createDataFrame([(0, "Ada")], "label int, subject_id string")
    result = serving.score(spark.createDataFrame(asked, REQUEST), run.model, names, uri, **SIZES)
    best = {r.request_id: (r.predictions[0].subject_id, len(r.predictions)) for r in result.responses.collect()}
    assert best == {"q0": ("Ada", 2), "q1": ("S0001", 2), "q2": ("S0002", 2)}
    flat = result.responses.select(F.explode("predictions").alias("p")).select("p.*")
    assert guard.separate(flat, checks.candidate_rules())[1].count() == 0
    reasons = {r.request_id: r.reason.split(":")[0] for r in result.rejected.collect()}
    assert reasons == {"broken": "iris_b64,top_k", "empty": "iris empty", "junk": "iris unreadable"}


def test_frames_from_a_media_directory(spark, tmp_path):
    import pytest

    from shardloom.errors import ScanFault
    from shardloom.operators import media
    from shardloom.plans.directory import frames_from_media, list_subjects
    from shardloom.sources.media import scan_media, write_media

    picture = pixels.write_png(np.arange(64 * 64).reshape(64, 64) % 256)
    files = [(f"iris/s1/{side}/{i:02d}.png", picture) for side in ("left", "right") for i in range(11)]
    files += [("iris/s2/a.png", picture), ("iris/s0/a.png", picture), ("fingerprint/s3/a.png", picture)]
    files += [("fingerprint/s1/b.png", b"second"), ("fingerprint/s1/a.png", b"first"), ("fingerprint/s2/x.bmp", b"x")]
    root = str(tmp_path)
    write_media(spark.createDataFrame(files, "name string, content binary"), root)
    found = scan_media(spark, root)
    assert [r[0] for r in list_subjects(found).collect()] == ["s1", "s2"]
    frames = frames_from_media(found)
    assert frames.schema.fieldNames() == FRAME.fieldNames()
    rows = sorted(frames.collect(), key=lambda r: (r.subject_id, r.sample_id))
    assert len(rows) == 23
    assert {(r.subject_id, r.label, bytes(r.fingerprint_bytes)) for r in rows} == {("s1", 0, b"first"), ("s2", 1, b"x")}
    assert [r.split for r in rows if r.subject_id == "s2"] == ["train"]
    # 22 samples of s1: one test row, three val rows, in path order, so all from the left folder.
    held = sorted((r.split, r.sample_id) for r in rows if r.split != "train")
    assert held == [("test", "s1_00"), ("val", "s1_01"), ("val", "s1_02"), ("val", "s1_03")]
    assert bytes(rows[0].iris_bytes) == picture
    only = frames_from_media(found, spark.createDataFrame([("s2",)], "shard_id string"))
    assert [(r.subject_id, r.label) for r in only.collect()] == [("s2", 1)]
    with pytest.raises(ScanFault):
        frames_from_media(found, spark.createDataFrame([("s0",)], "shard_id string"))
    with pytest.raises(ScanFault):
        frames_from_media(found.filter("modality = 'iris'"))
    assert media.decoded(media.decode_frames(frames)).count() == 0  # the fingerprints are no images
