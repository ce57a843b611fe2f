import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.functions import arrays as a
from shardloom.functions import pixels as px
from shardloom.operators import media
from shardloom.schemas import FRAME
from shardloom.sources.media import read_images, scan_media, write_media

rng = np.random.default_rng(0)


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(pixels, colour, filters, palette=None):
    """A PNG whose rows use the given filters in turn."""
    height, width = pixels.shape[:2]
    flat = pixels.reshape(height, -1).astype(int)
    step = flat.shape[1] // width
    out = io.BytesIO()
    above = np.zeros(flat.shape[1], int)
    for y, row in enumerate(flat):
        kind = filters[y % len(filters)]
        line = []
        for i, value in enumerate(row):
            left = row[i - step] if i >= step else 0
            corner = above[i - step] if i >= step else 0
            estimate = left + above[i] - corner
            distances = [abs(estimate - v) for v in (left, above[i], corner)]
            paeth = (left, above[i], corner)[distances.index(min(distances))]
            guess = [0, left, above[i], (left + above[i]) // 2, paeth][kind]
            line.append((value - guess) % 256)
        out.write(bytes([kind, *line]))
        above = row
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    extra = chunk(b"PLTE", palette.tobytes()) if palette is not None else b""
    data = zlib.compress(out.getvalue())
    body = chunk(b"IDAT", data[:7]) + chunk(b"IDAT", data[7:])
    return px.PNG_SIGNATURE + chunk(b"IHDR", head) + extra + body + chunk(b"IEND", b"")


def grey(rgb):
    r, g, b = (rgb[..., i].astype(int) for i in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 32768) // 65536).astype(np.uint8)


def test_png_filters_and_colours():
    plain = rng.integers(0, 256, (11, 7), dtype=np.uint8)
    for filters in ([0], [1], [2], [3], [4], [0, 1, 2, 3, 4]):
        assert (px.read_grey(png(plain, 0, filters)) == plain).all()
    rgb = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8)
    assert (px.read_grey(png(rgb, 2, [4, 1])) == grey(rgb)).all()
    rgba = rng.integers(0, 256, (6, 5, 4), dtype=np.uint8)
    assert (px.read_grey(png(rgba, 6, [3])) == grey(rgba)).all()
    with_alpha = rng.integers(0, 256, (4, 4, 2), dtype=np.uint8)
    assert (px.read_grey(png(with_alpha, 4, [1])) == with_alpha[..., 0]).all()
    palette = rng.integers(0, 256, (9, 3), dtype=np.uint8)
    index = rng.integers(0, 9, (4, 6), dtype=np.uint8)
    assert (px.read_grey(png(index, 3, [0], palette)) == grey(palette[index])).all()
    assert (px.read_grey(px.write_png(plain)) == plain).all()


def test_bmp():
    rgb = rng.integers(0, 256, (3, 5, 3), dtype=np.uint8)
    rows = b"".join(r[:, ::-1].tobytes() + b"\0" for r in rgb[::-1])
    head = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(rows), 0, 0, 54, 40, 5, 3, 1, 24, 0, len(rows), 0, 0, 0, 0)
    assert (px.read_grey(head + rows) == grey(rgb)).all()


@pytest.mark.parametrize("raw", [b"", b"junk", px.PNG_SIGNATURE, b"BM", px.write_png(np.zeros((4, 4)))[:-20]])
def test_unreadable_bytes(raw):
    with pytest.raises(ValueError):
        px.read_grey(raw)


def test_damaged_png_is_noticed():
    raw = bytearray(px.write_png(rng.integers(0, 256, (8, 8))))
    raw[45] ^= 1
    with pytest.raises(ValueError):
        px.read_grey(bytes(raw))


def resized_by_hand(pixels, height, width):
    """Triangle filter pixel by pixel, columns first, 8 bits in between."""

    def line(values, target):
        out = []
        scale = len(values) / target
        reach = max(1.0, scale)
        for t in range(target):
            centre = (t + 0.5) * scale
            first, last = max(0, int(centre - reach + 0.5)), min(len(values), int(centre + reach + 0.5))
            weights = [max(0.0, 1 - abs((i - centre + 0.5) / reach)) for i in range(first, last)]
            mean = sum(w * values[i] for w, i in zip(weights, range(first, last), strict=True)) / sum(weights)
            out.append(min(255, max(0, int(mean + 0.5))))
        return out

    wide = np.array([line(list(map(int, row)), width) for row in pixels])
    return np.array([line(list(map(int, col)), height) for col in wide.T]).T


@pytest.mark.parametrize("shape", [(64, 64), (96, 96), (32, 100), (200, 50), (1, 1), (130, 64)])
def test_resize(shape):
    pixels = rng.integers(0, 256, shape, dtype=np.uint8)
    found = px.resize(pixels, 64, 64)
    difference = np.abs(found.astype(int) - resized_by_hand(pixels, 64, 64))
    assert difference.max() <= 1 and (difference > 0).mean() < 0.01  # fixed point against floats
    if shape == (64, 64):
        assert (found == pixels).all()


def encoded_frames(spark, n=70):
    rows = []
    for i in range(n):
        iris, finger = rng.integers(0, 256, (64, 64)), rng.integers(0, 256, (96, 96))
        rows.append((1, f"S{i}", f"x{i}", px.write_png(iris), px.write_png(finger), i, "train", "s"))
    return rows


def test_decode_frames(spark):
    rows = encoded_frames(spark)
    tiles = media.decoded(media.decode_frames(spark.createDataFrame(rows, FRAME))).collect()
    assert len(tiles) == 70
    by_id = {r.sample_id: r for r in tiles}
    for row in rows:
        tile = by_id[row[2]]
        expected = px.read_grey(row[3]).astype(np.float32).ravel() / np.float32(255)
        assert np.array_equal(np.array(tile.iris, np.float32), expected)
        assert len(tile.fingerprint) == 96 * 96 and tile.label == row[5]
        assert 0 <= min(tile.fingerprint) and max(tile.fingerprint) <= 1


def test_quarantine_names_sample_and_modality(spark):
    good = encoded_frames(spark, 1)[0]
    rows = [good] + [
        (1, "S", f"bad{i}", iris, finger, 0, "train", "s")
        for i, (iris, finger) in enumerate([(b"", good[4]), (None, good[4]), (good[3], b"junk"), (good[3], None)])
    ]
    bad = media.quarantine(media.decode_frames(spark.createDataFrame(rows, FRAME))).collect()
    found = {r.sample_id: " ".join(r.error.replace(":", "").split()[:2]) for r in bad}
    assert found == {
        "bad0": "iris empty", "bad1": "iris empty",
        "bad2": "fingerprint unreadable", "bad3": "fingerprint empty",
    }


def test_media_directory(spark, tmp_path):
    root = str(tmp_path / "iris" / "data")  # a modality name above the root must not confuse the scan
    tile = rng.integers(0, 256, (64, 64), dtype=np.uint8)
    names = ["iris/s1/left/a.png", "iris/s1/right/b.png", "fingerprint/s1/c.png", "iris/s2/d.PNG", "iris/s2/e.txt"]
    rows = [(n, px.write_png(tile)) for n in names] + [("fingerprint/s3/junk.jpg", b"junk"), ("other/s4/x.png", b"x")]
    write_media(spark.createDataFrame(rows, "name string, content binary"), root)
    found = {(r.modality, r.subject_id, r.stem) for r in scan_media(spark, root).collect()}
    assert found == {
        ("iris", "s1", "a"), ("iris", "s1", "b"), ("fingerprint", "s1", "c"), ("fingerprint", "s3", "junk"),
    }
    content = scan_media(spark, root).filter("stem = 'a'").first().content
    assert bytes(content) == px.write_png(tile)
    images = media.decode_images(read_images(spark, root), (64, 64)).collect()
    errors = {r.path.rsplit("/", 1)[1] for r in images if r.error}
    assert errors == {"junk.jpg", "x.png"}
    expected = tile.astype(np.float32).ravel() / np.float32(255)
    assert all(np.array_equal(np.array(r.tile, np.float32), expected) for r in images if not r.error)


# --- arrays ---------------------------------------------------------------------------------------


def test_softmax_layer_norm_argmax(spark):
    rows = [([float(x) for x in rng.normal(size=6)],) for _ in range(20)] + [([1000.0, 1000.0, -1000.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    out = df.select(
        "v", a.softmax(F.col("v")).alias("p"), a.layer_norm(F.col("v")).alias("z"), a.argmax(F.col("v")).alias("m")
    )
    for r in out.collect():
        v = np.array(r.v)
        e = np.exp(v - v.max())
        assert np.allclose(r.p, e / e.sum()) and r.m == v.argmax()
        assert np.allclose(r.z, (v - v.mean()) / np.sqrt(v.var() + 1e-5))


def tiles(spark, n=400):
    rows = [(i, [float(j) for j in range(6)], [float(j) for j in range(12)]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, iris array<double>, fingerprint array<double>")


SIZES = {"iris": (2, 3), "fingerprint": (3, 4)}


def test_flip_is_joint_and_fair(spark):
    out = tiles(spark).repartition(5).transform(media.random_flip("id", 7, sizes=SIZES)).collect()
    iris, finger = np.arange(6.0).reshape(2, 3), np.arange(12.0).reshape(3, 4)
    flipped = 0
    for r in out:
        turned = r.iris == iris[:, ::-1].ravel().tolist()
        flipped += turned
        assert r.iris == (iris[:, ::-1] if turned else iris).ravel().tolist()
        assert r.fingerprint == (finger[:, ::-1] if turned else finger).ravel().tolist()
    assert 140 < flipped < 260
    never = tiles(spark).transform(media.random_flip("id", 7, probability=0.0, sizes=SIZES))
    assert never.exceptAll(tiles(spark)).count() == 0


def test_noise_is_normal_seeded_and_clipped(spark):
    df = spark.range(300).select("id", F.array_repeat(F.lit(0.5), 64).alias("iris"))

    def noise(seed, epoch=0, std=0.02):
        rows = df.repartition(3).transform(media.random_noise("id", seed, epoch, std)).orderBy("id").collect()
        return np.array([r.iris for r in rows]) - 0.5

    drawn = noise(1)
    assert np.array_equal(drawn, noise(1)) and not np.array_equal(drawn, noise(1, 1))
    flat = drawn.ravel() / 0.02
    assert abs(flat.mean()) < 0.03 and abs(flat.std() - 1) < 0.03
    assert abs((flat**3).mean()) < 0.1 and abs((flat**4).mean() - 3) < 0.3
    assert abs(np.corrcoef(drawn[:, :-1].ravel(), drawn[:, 1:].ravel())[0, 1]) < 0.03
    assert abs(np.corrcoef(drawn[:-1].ravel(), drawn[1:].ravel())[0, 1]) < 0.03
    wild = noise(1, std=50.0) + 0.5
    assert wild.min() == -3.0 and wild.max() == 3.0


def test_compose_runs_in_order(spark):
    df = tiles(spark, 3)
    both = media.compose(media.standardised(), media.random_flip("id", 1, probability=1.1, sizes=SIZES))
    row = df.transform(both).first()
    assert row.iris == [((x - 0.5) / 0.5) for x in (2.0, 1.0, 0.0, 5.0, 4.0, 3.0)]
