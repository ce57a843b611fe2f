"""Vector and tile arithmetic on array columns, inside whole-stage code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.functions.hashing import hash_word, uniform

LAYER_NORM_EPSILON = 1e-5
PIXEL_MEAN = PIXEL_STD = 0.5
FLIP_PROBABILITY = 0.5
NOISE_STD = 0.02
NOISE_LIMIT = 3.0

_PRIME = 2147483647  # products of two residues stay inside a long


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value`` computed once; a lambda would recompute it per element."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    def scaled(exps: Column) -> Column:
        return bind(total(exps), lambda s: F.transform(exps, lambda e: e / s))

    def exponentials(top: Column) -> Column:
        return F.transform(logits, lambda x: F.exp(x.cast("double") - top))

    return bind(bind(F.array_max(logits).cast("double"), exponentials), scaled)


def argmax(values: Column) -> Column:
    """Index of the largest value, the lowest index on ties."""
    return F.array_position(values, F.array_max(values)) - 1


def layer_norm(values: Column, epsilon: float = LAYER_NORM_EPSILON) -> Column:
    """``(x - mean) / sqrt(variance + epsilon)`` over one row's values, population variance."""

    def centred(deviations: Column) -> Column:
        variance = total(F.transform(deviations, lambda d: d * d)) / F.size(deviations)
        return bind(
            F.sqrt(variance + F.lit(epsilon)), lambda s: F.transform(deviations, lambda d: d / s)
        )

    def deviate(mean: Column) -> Column:
        return F.transform(values, lambda x: x.cast("double") - mean)

    doubles = F.transform(values, lambda x: x.cast("double"))
    return bind(bind(total(doubles) / F.size(values), deviate), centred)


def standardise(pixels: Column, mean: float = PIXEL_MEAN, std: float = PIXEL_STD) -> Column:
    return F.transform(pixels, lambda x: (x.cast("double") - F.lit(mean)) / F.lit(std))


def mirror(pixels: Column, height: Column, width: Column) -> Column:
    """Left-right mirror image of a row-major tile."""
    rows = F.sequence(F.lit(0), height - 1)
    return F.flatten(F.transform(rows, lambda r: F.reverse(F.slice(pixels, r * width + 1, width))))


def flip_coin(key: Column, seed: int, epoch: int = 0, probability: float = FLIP_PROBABILITY) -> Column:
    """One coin per sample, so both modalities flip together."""
    return uniform(F.lit(seed), F.lit(epoch), F.lit("flip"), key) < F.lit(probability)


def _residue(base: Column, index: Column) -> Column:
    """A well-mixed value in [0, prime) from a row's hash and an element index."""
    start = (base + (index.cast("bigint") + 1) * F.lit(1000003)) % F.lit(_PRIME)
    return bind(
        bind(start, lambda a: (a * a + a * 7 + base) % F.lit(_PRIME)),
        lambda b: (b * b + b * 13 + index) % F.lit(_PRIME),
    )


def gaussian_noise(
    pixels: Column,
    key: Column,
    seed: int,
    epoch: int = 0,
    std: float = NOISE_STD,
    limit: float = NOISE_LIMIT,
) -> Column:
    """Add seeded normal noise (Box-Muller on hashed uniforms) and clip to ``[-limit, limit]``."""

    def noisy(base: Column) -> Column:
        def element(x: Column, i: Column) -> Column:
            u1 = (_residue(base, i * 2) + 1.0) / F.lit(_PRIME + 1.0)
            u2 = (_residue(base, i * 2 + 1) + 1.0) / F.lit(_PRIME + 1.0)
            normal = F.sqrt(F.log(u1) * -2.0) * F.cos(u2 * F.lit(6.283185307179586))
            return F.greatest(
                F.lit(-limit), F.least(F.lit(limit), x.cast("double") + normal * F.lit(std))
            )

        return F.transform(pixels, element)

    return bind(hash_word(F.lit(seed), F.lit(epoch), F.lit("noise"), key), noisy)
