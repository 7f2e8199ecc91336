"""Sums of doubles that depend neither on the order nor on the partitioning of rows.

A double is a whole number of at most 53 bits times a power of two. It is cut into digits
of 22 bits at fixed places, which are summed as integers, so nothing is rounded: not the
smallest part next to the largest, and not whatever the partial sums were. Rows of one
magnitude share a ``place``, and a key has at most a hundred of them. The total is rounded once, at the end, to the
nearest double. A digit can be summed over 2 ** 41 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22
PARTS = ["digit_0", "digit_1", "digit_2", "digit_3"]
SUMS = [*PARTS, "odd"]


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2 ** (BITS * exponent)``, in two steps that stay in range."""
    half = F.pow(F.lit(2.0), exponent * (BITS // 2))
    return x * half * half


def digits(value: Column) -> dict[str, Column]:
    """``place``, four digits from this place down, and ``odd``: a value without digits."""
    finite = F.abs(value) < float("inf")
    place = F.floor(F.log2(F.when(finite & (value != 0), F.abs(value))) / BITS)
    place = F.coalesce(place, F.lit(0)).cast("int")
    # Near a power of two the logarithm may be off by a little: the first digit is then
    # one bit longer or shorter, and the four still hold all 53 bits.
    rest = _scaled(F.when(finite, value), -place)
    columns = {"place": place}
    for name in PARTS:
        whole = F.floor(rest)
        columns[name] = whole.cast("bigint")
        rest = (rest - whole) * float(1 << BITS)
    columns["odd"] = F.when(value.isNotNull() & ~finite, value)
    return columns


def partial_sums(
    df: DataFrame, keys: list[str], value: str, count: str = "n"
) -> DataFrame:
    """``(keys, place, digit_0 .. digit_3, odd, count)``: sums that merge exactly."""
    columns = digits(F.col(value))
    return df.select(*keys, *(c.alias(name) for name, c in columns.items())).groupBy(
        *keys, "place"
    ).agg(*(F.sum(c).alias(c) for c in SUMS), F.count("*").alias(count))


def merge(partial: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """The partial sums of coarser keys."""
    return partial.groupBy(*keys, "place").agg(
        *(F.sum(c).alias(c) for c in SUMS), F.sum(count).alias(count)
    )


def totals(partial: DataFrame, keys: list[str], total: str, count: str = "n") -> DataFrame:
    """``(keys, total, count)``: one double per key, rounded once.

    Null values add nothing; the total of nulls alone is 0.
    """
    digit = F.array(
        *(
            F.struct((F.col("place") - i).alias("place"), F.coalesce(c, F.lit(0)).alias("digit"))
            for i, c in enumerate(PARTS)
        )
    )
    per_key = partial.groupBy(*keys).agg(
        F.flatten(F.collect_list(digit)).alias("_digits"),
        F.sum("odd").alias("_odd"),
        F.sum(count).alias(count),
    )
    low = F.array_min(F.transform("_digits", lambda d: d["place"]))
    high = F.array_max(F.transform("_digits", lambda d: d["place"]))
    places = per_key.select("*", low.alias("_low"), F.sequence(low, high).alias("_places"))

    def at(place: Column) -> Column:
        own = F.filter("_digits", lambda d: d["place"] == place)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda s, d: s + d["digit"])

    # From the lowest place up, every digit keeps its 22 bits and hands on the rest.
    empty = F.array().cast("array<bigint>")
    carried = F.aggregate(
        F.transform("_places", at),
        F.struct(F.lit(0).cast("bigint").alias("carry"), empty.alias("kept")),
        lambda s, d: F.struct(
            F.shiftright(s["carry"] + d, BITS).alias("carry"),
            F.concat(
                s["kept"], F.array((s["carry"] + d).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint")))
            ).alias("kept"),
        ),
    )
    whole = "decimal(38,0)"
    # From the highest place down, as many digits as a decimal holds: 100 bits or more.
    # Whether anything is left below is all that rounding to 53 bits needs to know.
    folded = F.aggregate(
        F.reverse("_carried.kept"),
        F.struct(
            F.col("_carried.carry").cast(whole).alias("n"),
            F.lit(0).alias("used"),
            F.lit(False).alias("more"),
        ),
        lambda s, d: F.when(
            F.abs(s["n"]) < F.lit(str(1 << 100)).cast(whole),
            F.struct(
                (s["n"] * F.lit(1 << BITS) + d).cast(whole).alias("n"),
                (s["used"] + 1).alias("used"),
                s["more"].alias("more"),
            ),
        ).otherwise(
            F.struct(s["n"].alias("n"), s["used"].alias("used"), (s["more"] | (d != 0)).alias("more"))
        ),
    )
    n = (F.col("_folded.n") * 2 + F.col("_folded.more").cast("int")).cast(whole).cast("double")
    lowest = F.col("_low") + F.size("_carried.kept") - F.col("_folded.used")
    exact = _scaled(n / 2, lowest)
    return (
        places.select("*", carried.alias("_carried"))
        .select("*", folded.alias("_folded"))
        .select(*keys, F.coalesce("_odd", exact).alias(total), count)
    )
