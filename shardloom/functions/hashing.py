"""Digests, derived keys and hash-based uniforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_checksum(shard_id: Column, operation: Column, path: Column) -> Column:
    """SHA-256 hex of ``shard:operation:path``; null when any part is null."""
    sep = F.lit(":")
    return F.sha2(F.concat(shard_id, sep, operation, sep, path), 256)


def content_hash(content: Column) -> Column:
    """SHA-256 hex of a string's UTF-8 bytes or of a binary value."""
    return F.sha2(content.cast("binary"), 256)


def _big_endian_word(value: Column) -> Column:
    return F.lpad(F.hex(value.cast("bigint")), 8, "0")


def shard_name(seed: Column, index: Column) -> Column:
    """``shard_<index>_<8 hex>``, the hex taken from SHA-256 of both 32-bit big-endian words."""
    words = F.unhex(F.concat(_big_endian_word(seed), _big_endian_word(index)))
    return F.format_string("shard_%04d_%s", index, F.substring(F.sha2(words, 256), 1, 8))


def subject_name(ordinal: Column) -> Column:
    return F.format_string("S%04d", ordinal)


def sample_name(ordinal: Column, sample: Column) -> Column:
    return F.format_string("S%04d_s%02d", ordinal, sample)


def path_stem(path: Column) -> Column:
    """File name without directory and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def path_order(path: Column) -> Column:
    """Text that sorts paths folder by folder, so ``a/x`` comes before ``a-b/x``."""
    return F.translate(path, "/", "\u0001")


def json_text(value: Column) -> Column:
    """``value`` as a JSON literal; characters beyond ASCII stay as they are."""
    member = F.to_json(F.struct(value.alias("v")))  # {"v":...}
    inner = F.substring(member, F.lit(6), F.length(member) - 6)
    return F.when(value.isNull(), "null").otherwise(inner)


def config_document(config: Column) -> Column:
    """JSON object with sorted keys from a map of key to JSON fragment.

    A fragment is ``json_text(...)``, a number, or another ``config_document``, so nested
    configurations are built inside out. Null fragments become ``null``.
    """
    members = F.transform(
        F.array_sort(F.map_entries(config)),
        lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), F.coalesce(e["value"], F.lit("null"))),
    )
    return F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))


def config_hash(config: Column) -> Column:
    """First 16 hex digits of SHA-256 of the sorted-key document."""
    return F.substring(F.sha2(config_document(config), 256), 1, 16)


def hash_word(*parts: Column) -> Column:
    """A 32-bit number from MD5 of the parts joined by ``:``; equal wherever it is computed."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts; independent of partitioning and retries."""
    return hash_word(*parts) / F.lit(4294967296.0)
