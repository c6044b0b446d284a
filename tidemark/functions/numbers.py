"""Rounding, percentages and percentiles as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int = 0) -> Column:
    """Halves go up, on the binary value: floor(x * 10**digits + 0.5) / 10**digits."""
    scale = float(10**digits)
    return F.floor(x.cast("double") * scale + 0.5).cast("double") / F.lit(scale)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(round_half_up(part.cast("double") / whole * 100.0, digits))


def percentile_at(values: Column, p: float) -> Column:
    """Of the sorted values the one at index min(n - 1, floor(p / 100 * n)); null for none. One group's
    values are collected, so group by something that keeps groups bounded."""
    ordered = F.array_sort(values)
    at = F.least(F.size(ordered) - 1, F.floor(F.lit(p / 100.0) * F.size(ordered)).cast("int")) + 1
    return F.when(F.size(ordered) > 0, F.element_at(ordered, at))


def delta_text(before: Column, after: Column) -> Column:
    """Relative change in percent: an em dash where both are 0, +∞ where only the base is."""
    change = round_half_up((after - before) / before * 100.0, 1)
    text = F.concat(F.when(change > 0, F.lit("+")).otherwise(F.lit("")), F.format_string("%.1f", change), F.lit("%"))
    return F.when((before == 0) & (after == 0), F.lit("—")).when(before == 0, F.lit("+∞")).otherwise(text)


def model_cost(prompt_chars: Column, response_chars: Column) -> Column:
    """Dollars of a model call: four characters a token, 0.075 and 0.30 a million tokens."""
    return round_half_up((prompt_chars / 4.0 * 0.075 + response_chars / 4.0 * 0.30) / 1e6, 4)


def progress(done: Column, started: Column, queued: Column, in_flight: Column) -> Column:
    """Percent of the work that is done, 0 where there is none."""
    return percent(done, started + queued + in_flight, 0)
