"""Numbers and times: rounding, defaults, epoch conversion, ISO text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def half_even(value: Column, digits: int = 2) -> Column:
    """Round to ``digits`` places, ties to even, as numpy does."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as timestamp, fraction kept to the nearest microsecond."""
    return F.timestamp_micros(F.rint(seconds * 1e6).cast("bigint"))


def clock_text(ts: Column, separator: str = "T") -> Column:
    """ISO text of a timestamp in UTC; microseconds appear only when there are any."""
    micros = F.unix_micros(ts)
    day = F.floor(micros / F.lit(86_400_000_000))
    seconds = F.floor(F.pmod(micros, F.lit(86_400_000_000)) / 1_000_000).cast("int")

    def digits(number: Column, n: int = 2) -> Column:
        return F.lpad(number.cast("string"), n, "0")

    clock = F.concat_ws(
        ":",
        digits(F.floor(seconds / 3600)),
        digits(F.floor(seconds / 60) % 60),
        digits(seconds % 60),
    )
    fraction = F.pmod(micros, F.lit(1_000_000))
    return F.concat(
        F.date_from_unix_date(day.cast("int")).cast("string"),
        F.lit(separator),
        clock,
        F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), digits(fraction, 6))),
    )


def bins(value: Column, edges: Sequence[tuple[float | None, str]]) -> Column:
    """First label whose upper edge is at least ``value``; an edge of None is open."""
    label = F.lit(None).cast("string")
    for upper, name in reversed(list(edges)):
        if upper is None:
            label = F.when(value.isNotNull(), F.lit(name))
        else:
            label = F.when(value <= upper, F.lit(name)).otherwise(label)
    return label


def share_of(count: Column, total: Column) -> Column:
    return F.lit(100.0) * count / total


def title_label(name: Column) -> Column:
    """``unique_authors`` as ``Unique Authors``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def column_or(df: DataFrame, name: str, default=None) -> Column:
    """The column, its NULLs replaced by ``default``; the default where it is absent."""
    if name not in df.columns:
        return F.lit(default)
    return F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))
