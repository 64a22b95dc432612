"""Hashes, seeds and identities of records. Canonical form: fields in a fixed order, joined by NUL, hashed as UTF-8."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..policy import GENERATOR_VERSION


def _column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def joined(*parts) -> Column:
    """Parts as strings with a NUL between; a null part is an empty one."""
    return F.concat_ws("\u0000", *[F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts])


def structured_hash(*parts) -> Column:
    return F.sha2(joined(*parts).cast("binary"), 256)


def seed_hex(version, root, family, ordinal) -> Column:
    """128-bit seed as 32 hexadecimal digits."""
    return F.substring(structured_hash(version, root, family, ordinal), 1, 32)


def seed64(version, root, family, ordinal) -> Column:
    """64-bit unsigned seed as decimal(20,0)."""
    return F.conv(F.substring(structured_hash(version, root, family, ordinal), 1, 16), 16, 10).cast("decimal(20,0)")


def record_id(family, ordinal, seed, version=GENERATOR_VERSION) -> Column:
    return structured_hash(version, family, ordinal, seed)


def functional_signature(kind, operation, family) -> Column:
    return structured_hash(kind, operation, family)


def draw(seed: Column, index: int, low, high) -> Column:
    """A whole number from low to high, both included, from the index-th draw of a seed: a hash, not a generator state."""
    low, high = _column(low).cast("long"), _column(high).cast("long")
    bits = F.conv(F.substring(structured_hash(seed, index), 1, 15), 16, 10).cast("long")
    return low + F.pmod(bits, high - low + 1)


def seed_number(root: int, family: str, ordinal: int, version: str = GENERATOR_VERSION) -> int:
    """The seed of one family on the driver, for generator constants."""
    body = "\u0000".join([version, str(root), family, str(ordinal)]).encode()
    return int(hashlib.sha256(body).hexdigest()[:32], 16)


def config_fingerprint(config: dict, mutable: tuple[str, ...] = ("status", "manifest_sha256")) -> str:
    """Hash of what a generation depends on: sorted JSON without the mutable pins, wherever they stand."""

    def pinned(x):
        if isinstance(x, dict):
            return {k: pinned(v) for k, v in x.items() if k not in mutable}
        return [pinned(v) for v in x] if isinstance(x, list) else x

    return hashlib.sha256(json.dumps(pinned(config), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
