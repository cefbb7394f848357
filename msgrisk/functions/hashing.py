"""Keyed hashes for sampling that give the same answer however the rows are laid out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNIT_RANGE = 2.0 ** 32


def keyed_digest(key: Column, seed: int | str) -> Column:
    """Hex md5 of seed and key. A missing key counts as the empty text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def digest_number(digest: Column, digits: int = 8) -> Column:
    """The leading hex digits of a digest as a bigint."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) fixed by seed and key."""
    return digest_number(keyed_digest(key, seed)) / F.lit(UNIT_RANGE)
