"""Size checks for anything that reaches the driver or is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Upper bound on category lists and lookup tables turned into literals/broadcasts.
MAX_CATEGORIES = 10_000


class TooLargeError(ValueError):
    """A result that was expected to be small is not."""


def collect_bounded(df: DataFrame, max_rows: int = MAX_CATEGORIES, what: str = "result") -> list[Row]:
    """Collect at most ``max_rows`` rows; raise if there are more."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooLargeError(f"{what} has more than {max_rows} rows; refusing to bring it to the driver")
    return rows


def is_small(df: DataFrame, max_rows: int = MAX_CATEGORIES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left", max_rows: int = MAX_CATEGORIES) -> DataFrame:
    """Broadcast ``small`` only after checking its row count; else a shuffle join
    (AQE may still turn it into a broadcast from runtime statistics)."""
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
