"""Rounding as Python does it (MTH2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float((1 << 27) + 1)  # parts a double into two halves of 26 bits
_LARGE = float(1 << 51)


def py_round(x: Column, digits: int = 2) -> Column:
    """MTH2: ``round(x, digits)`` of a double: the nearest decimal of the *exact* value, ties to even.

    0.175 is a little less than it looks and gives 0.17; 0.125 is a tie and
    gives 0.12.  The value is parted into two halves whose products with a power
    of ten are exact, so the sign of what is left beside the midpoint is, too.
    For 0 to 6 digits; values of 2^51 / 10^digits or more, NaN and infinities stay as they are.
    """
    if not 0 <= digits <= 6:
        raise ValueError("0 to 6 digits")
    size, scale = F.abs(x), float(10 ** digits)
    moved = size * _SPLIT
    high = moved - (moved - size)
    low = size - high
    guess = F.floor(size * scale).cast("double")

    def beyond(k: Column, times: float) -> Column:
        """The exact sign of ``size * times - k``."""
        return (high * times - k) + low * times

    k = F.when(beyond(guess, scale) < 0, guess - 1).when(beyond(guess + 1, scale) >= 0, guess + 1).otherwise(guess)
    side = beyond(2 * k + 1, 2 * scale)
    up = (side > 0) | ((side == 0) & (F.pmod(k, F.lit(2.0)) == 1))
    rounded = F.when(up, k + 1).otherwise(k) / scale
    return F.when(size < _LARGE / scale, F.when(x < 0, -rounded).otherwise(rounded)).otherwise(x)
