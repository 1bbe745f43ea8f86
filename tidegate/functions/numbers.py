"""Rounding that agrees with correctly rounded binary doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = float(2**27 + 1)
_WHOLE = float(2**52)


def round_exact(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places by its exact binary value, true ties to even.

    ``round`` works on the shortest decimal text, so 0.975 becomes 0.98 there
    although the stored double lies below the tie.  Here the product with
    10**digits is formed without error (value split into two halves, rounding
    error carried along), and only a real tie is rounded to even.
    """
    scale = float(10**digits)
    product = value * scale
    big = value * _SPLIT
    high = big - (big - value)
    low = value - high
    error = (high * scale - product) + low * scale
    at_tie = (product - F.floor(product)) == 0.5
    nearest = (
        F.when(at_tie & (error > 0), F.ceil(product).cast("double"))
        .when(at_tie & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return F.when(F.abs(product) >= _WHOLE, value).otherwise(nearest / scale)
