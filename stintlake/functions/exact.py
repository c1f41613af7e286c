"""Sums of doubles that are exact, whatever the order and size of the values, and can be subtracted again.

The exponents of doubles are cut into bands of ``BITS`` bits. A value is the sum of three whole numbers below ``2 ** BITS``,
each in units of one of three neighbouring bands; cutting it up rounds nothing, as only powers of two and whole parts are
involved. A sum is then one 64-bit integer per band, and so are differences of running sums: a value far above or below the
others has bands of its own and leaves theirs alone. Up to ``2 ** 31`` values go into a sum.

Only the bands that a column has get a sum; one scan finds them. Ordinary columns have three or four of the sixty-eight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32


def finite(value: Column | str) -> Column:
    """The value as a double; not-a-number and infinite ones are null."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _scaled(x: Column, band: Column | int) -> Column:
    """``x`` times ``2 ** (BITS * band)``, in two steps that neither overflow nor underflow on the way."""
    step = F.pow(F.lit(2.0), band * (BITS // 2) if isinstance(band, Column) else F.lit(band * (BITS // 2)))
    return x * step * step


def chunks(value: Column | str) -> Column:
    """A struct of the highest band ``k`` and the whole numbers ``c0, c1, c2`` of the bands k, k-1, k-2; zeros for null."""
    x = finite(value)
    size = F.abs(x)
    # at the edge of a band the logarithm may say the next one, which a whole number has room for
    k = F.coalesce(F.floor(F.log2(F.nullif(size, F.lit(0.0))) / BITS).cast("int"), F.lit(0))
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    first = F.coalesce(_scaled(size, -k), F.lit(0.0))
    second = (first - F.floor(first)) * float(1 << BITS)
    third = (second - F.floor(second)) * float(1 << BITS)
    return F.struct(
        k.alias("k"), (sign * F.floor(first)).alias("c0"), (sign * F.floor(second)).alias("c1"), (sign * third.cast("long")).alias("c2")
    )


def bands(df: DataFrame, columns: list[str]) -> dict[str, list[int]]:
    """The bands in which values of each column have bits, from one scan of the columns."""
    if not columns:
        return {}
    masks = []
    for c in columns:
        for j in range(3):
            at, there = F.col(f"_{c}.k") - j, F.col(f"_{c}.c{j}") != 0
            masks.append(F.bit_or(F.when(there & (at >= 0), F.expr(f"shiftleft(1L, `_{c}`.k - {j})")).otherwise(F.lit(0).cast("long"))))
            masks.append(F.bit_or(F.when(there & (at < 0), F.expr(f"shiftleft(1L, {j} - `_{c}`.k)")).otherwise(F.lit(0).cast("long"))))
    row = df.select(*[chunks(c).alias(f"_{c}") for c in columns]).agg(*[m.alias(f"m{i}") for i, m in enumerate(masks)]).first()
    found = {}
    for i, c in enumerate(columns):
        mine: set[int] = set()
        for high, low in zip(row[6 * i : 6 * i + 6 : 2], row[6 * i + 1 : 6 * i + 6 : 2]):
            mine |= {b for b in range(63) if (high or 0) >> b & 1} | {-b for b in range(63) if (low or 0) >> b & 1}
        found[c] = sorted(mine)
    return found


def part(cut: Column, band: int) -> Column:
    """What a value cut by ``chunks`` has in ``band``."""
    k = cut["k"]
    return F.when(k == band, cut["c0"]).when(k == band + 1, cut["c1"]).when(k == band + 2, cut["c2"]).otherwise(F.lit(0).cast("long"))


def total(sums: dict[int, Column]) -> Column:
    """The double next to the sum that has ``sums`` as its bands, within two units in the last place."""
    at, carry, parts = sorted(sums), F.lit(0).cast("long"), []
    for i, band in enumerate(at):
        here = sums[band] + (carry if i and at[i - 1] == band - 1 else F.lit(0).cast("long"))
        if i + 1 < len(at) and at[i + 1] == band + 1:
            carry = F.shiftright(here, BITS)
            here = here - F.shiftleft(carry, BITS)
        parts.append(_scaled(here.cast("double"), band))
    out = F.lit(0.0)
    for p in parts:  # from the lowest up, so that little is lost
        out = out + p
    return out
