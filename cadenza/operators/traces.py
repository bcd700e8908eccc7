"""Rolling medians and quantile envelopes along timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import finite
from cadenza.operators.masks import along


def odd_window(fps: float, seconds: float, least: int) -> int:
    """Rows of a centred window: an odd number of at least `least`."""
    return max(least, round(fps * seconds)) | 1


def rolling_quantiles(df: DataFrame, key: str, value: str, rows: int, quantiles: dict[str, float], known: int, idx: str = "idx") -> DataFrame:
    """df with one column for each quantile: over the finite values within rows // 2 of each row, null with fewer than `known` of them."""
    w = along(key, idx).rowsBetween(-(rows // 2), rows // 2)
    x = finite(F.col(value))
    enough = F.count(x).over(w) >= known
    return df.withColumns({name: F.when(enough, F.percentile(x, F.lit(q)).over(w)) for name, q in quantiles.items()})


def smooth(df: DataFrame, key: str, value: str, fps: float = 24.0, idx: str = "idx") -> DataFrame:
    """df with <value>_smooth (rolling median of 0.375 s) and <value>_p10, <value>_p90 (envelope of 1 s)."""
    df = rolling_quantiles(df, key, value, odd_window(fps, 0.375, 3), {f"{value}_smooth": 0.5}, 3, idx)
    return rolling_quantiles(df, key, value, odd_window(fps, 1.0, 5), {f"{value}_p10": 0.1, f"{value}_p90": 0.9}, 5, idx)


def interpolated(values: Column, q: float) -> Column:
    """The linearly interpolated quantile of an array's finite values; null if there are none."""
    known = F.array_sort(F.filter(values, lambda x: (~F.isnan(x)) & (F.abs(x) < float("inf"))))
    at = (F.size(known) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(known, low), F.get(known, F.least(low + 1, F.size(known) - 1))
    return F.when(F.size(known) > 0, a + (b - a) * (at - low))
