"""String hashes that other systems also compute, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.values import VISITOR_HASH_BITS, VISITOR_HASH_SEED


def poly_hash(text: Column, seed: int = VISITOR_HASH_SEED, bits: int = VISITOR_HASH_BITS) -> Column:
    """Polynomial string hash reduced to ``bits`` bits.

    Reducing at every step equals masking at the end, and cannot overflow.
    """
    chars = F.split(text, "")
    size = F.lit(1 << bits).cast("long")
    step = F.aggregate(
        chars, F.lit(0).cast("long"), lambda h, c: (h * F.lit(seed) + F.ascii(c)) % size
    )
    return F.when(text == "", F.lit(0).cast("long")).otherwise(step)


def username_id(name: Column) -> Column:
    """Signed 32-bit string hash (base 31) that serves as user id."""
    unsigned = poly_hash(name, seed=31, bits=32)
    return (
        F.when(unsigned >= F.lit(1 << 31), unsigned - F.lit(1 << 32)).otherwise(unsigned)
    ).cast("int")
