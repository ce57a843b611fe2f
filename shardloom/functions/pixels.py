"""Small NumPy helpers that run inside Arrow batches: read one image, shrink or grow it.

Binary columns may hold PNG (8 bit, not interlaced) and BMP (uncompressed 8, 24 or 32 bit), the same on
every machine. Other formats, JPEG among them, go through directories, which Spark's own ``image`` source
decodes.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
# Samples per pixel by PNG colour type; integer luma weights (16-bit fixed point).
PNG_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
LUMA = (19595, 38470, 7471)
_FRACTION_BITS = 22


def luma(rgb: np.ndarray) -> np.ndarray:
    """(h, w, 3) RGB to 8-bit grey."""
    weighted = rgb[..., :3].astype(np.int64) @ np.array(LUMA, dtype=np.int64)
    return ((weighted + 0x8000) >> 16).astype(np.uint8)


def _png_chunks(raw: bytes):
    at = len(PNG_SIGNATURE)
    while at + 12 <= len(raw):
        (length,) = struct.unpack_from(">I", raw, at)
        kind, body = raw[at + 4 : at + 8], raw[at + 8 : at + 8 + length]
        if at + 12 + length > len(raw):
            raise ValueError("truncated PNG")
        (crc,) = struct.unpack_from(">I", raw, at + 8 + length)
        if crc != zlib.crc32(kind + body):
            raise ValueError("PNG chunk does not match its CRC")
        yield kind, body
        at += 12 + length


def _unfilter(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """Undo one PNG row filter; ``step`` is the number of bytes per pixel."""
    if kind == 0:
        return row
    if kind == 1:
        return (
            np.add.accumulate(row.reshape(-1, step).astype(np.int64), axis=0).astype(np.uint8).ravel()
        )
    if kind == 2:
        return row + above
    done = row.astype(np.int64)
    up = above.astype(np.int64)
    for i in range(len(done)):
        left = done[i - step] if i >= step else 0
        if kind == 3:
            guess = (left + up[i]) // 2
        elif kind == 4:
            corner = up[i - step] if i >= step else 0
            estimate = left + up[i] - corner
            guess = min((left, up[i], corner), key=lambda v: abs(estimate - v))
        else:
            raise ValueError(f"unknown PNG filter {kind}")
        done[i] = (done[i] + guess) & 0xFF
    return done.astype(np.uint8)


def _read_png(raw: bytes) -> np.ndarray:
    header, palette, packed = None, None, []
    for kind, body in _png_chunks(raw):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
    if header is None:
        raise ValueError("PNG without header")
    width, height, depth, colour, _, _, interlace = header
    if depth != 8 or interlace or colour not in PNG_SAMPLES:
        raise ValueError("only 8-bit, non-interlaced PNG can be read")
    samples = PNG_SAMPLES[colour]
    data = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    lines = data.reshape(height, 1 + width * samples)
    above, rows = np.zeros(width * samples, np.uint8), []
    for line in lines:
        above = _unfilter(int(line[0]), line[1:], above, samples)
        rows.append(above)
    pixels = np.stack(rows).reshape(height, width, samples)
    if colour == 3:
        return luma(palette[pixels[..., 0]])
    return luma(pixels) if samples >= 3 else pixels[..., 0]


def _read_bmp(raw: bytes) -> np.ndarray:
    (start, size, width, height) = struct.unpack_from("<IIii", raw, 10)
    bits, compression = struct.unpack_from("<HI", raw, 28)
    if compression or bits not in (8, 24, 32):
        raise ValueError("only uncompressed 8, 24 or 32-bit BMP can be read")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(raw, np.uint8, abs(height) * stride, start).reshape(abs(height), stride)
    if height > 0:  # stored bottom-up
        rows = rows[::-1]
    pixels = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    if bits == 8:
        palette = np.frombuffer(raw, np.uint8, start - 14 - size, 14 + size).reshape(-1, 4)
        return luma(palette[pixels[..., 0]][..., [2, 1, 0]])
    return luma(pixels[..., [2, 1, 0]])


def read_grey(raw: bytes) -> np.ndarray:
    """8-bit grey pixels of an encoded image; ``ValueError`` if it cannot be read."""
    if not raw:
        raise ValueError("empty")
    try:
        if raw.startswith(PNG_SIGNATURE):
            return _read_png(raw)
        if raw.startswith(b"BM"):
            return _read_bmp(raw)
    except (OSError, zlib.error, struct.error, IndexError, TypeError) as error:
        raise ValueError(f"unreadable: {error}") from error
    raise ValueError("unreadable: not a known image format")


@lru_cache(maxsize=256)
def _weights(source: int, target: int) -> np.ndarray:
    """Fixed-point triangle-filter weights, target x source; the filter widens when shrinking."""
    scale = source / target
    reach = max(scale, 1.0)
    table = np.zeros((target, source), dtype=np.int64)
    for t in range(target):
        centre = (t + 0.5) * scale
        first = max(int(centre - reach + 0.5), 0)
        last = min(int(centre + reach + 0.5), source)
        at = (np.arange(first, last) - centre + 0.5) / reach
        weight = np.maximum(0.0, 1.0 - np.abs(at))
        weight /= weight.sum()
        table[t, first:last] = np.floor(weight * (1 << _FRACTION_BITS) + 0.5).astype(np.int64)
    return table


def _blend(pixels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    mixed = pixels.astype(np.int64) @ weights.T + (1 << (_FRACTION_BITS - 1))
    return np.clip(mixed >> _FRACTION_BITS, 0, 255).astype(np.uint8)


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize of 8-bit grey, columns then rows; native size is the identity."""
    if pixels.shape[1] != width:
        pixels = _blend(pixels, _weights(pixels.shape[1], width))
    if pixels.shape[0] != height:
        pixels = _blend(pixels.T, _weights(pixels.shape[0], height)).T
    return pixels


def unit_tile(raw: bytes, height: int, width: int) -> np.ndarray:
    """Encoded image to row-major float32 in [0, 1]."""
    return resize(read_grey(raw), height, width).astype(np.float32).ravel() / np.float32(255.0)


def write_png(pixels: np.ndarray) -> bytes:
    """Encode 8-bit grey as PNG."""
    height, width = pixels.shape

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = np.hstack([np.zeros((height, 1), np.uint8), pixels.astype(np.uint8)])
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    body = zlib.compress(lines.tobytes(), 6)
    return PNG_SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", body) + chunk(b"IEND", b"")
