"""Output form shared by a registered query and its DuckDB oracle.

Two engines add the same doubles in different orders, so an average, a deviation or a
correlation can differ in the last bits. Those output columns, and no others, are put on a 1e-6
grid with an off-tie offset, ``floor(x * 1e6 + 0.5003) / 1e6``; the oracle SQL applies the same
text. NULL, NaN and values of 1e9 and more pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1_000_000
OFFSET = 0.5003


LIMIT = 1e9


def offtie(c: Column) -> Column:
    return F.when(F.abs(c) < LIMIT, F.floor(c * float(SCALE) + OFFSET) / float(SCALE)).otherwise(c)


def on_grid(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Apply :func:`offtie` to the named columns, keeping names and order."""
    return df.withColumns({c: offtie(F.col(c)) for c in cols})


def ot(expr: str) -> str:
    """SQL text of :func:`offtie`."""
    return f"CASE WHEN abs({expr}) < {LIMIT:.0f} THEN floor(({expr}) * {SCALE} + {OFFSET}) / {SCALE} ELSE {expr} END"


def grid_sql(body: str, double_cols: list[str] | tuple[str, ...]) -> str:
    """Wrap a SELECT so the listed DOUBLE columns are on the grid (DuckDB ``* REPLACE``)."""
    if not double_cols:
        return body
    repl = ", ".join(f"{ot(c)} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS q_grid"
