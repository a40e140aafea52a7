"""Places in one order over a whole table, from the totals of a grid.

The order columns are cut into cells by plain arithmetic, so that a row's cell depends on the
row alone and nothing has to be written to pin it down. Cells are counted (combined before the
shuffle), their totals are summed up in order on the driver, and each row's place is the sum
before its cell and its place inside it. Only cells that hold too much are cut again: finer,
and by the next order column where rows agree in the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cells of the first grid at most, and times that a round cuts a crowded cell finer at most.
CELLS = 1 << 16
FINER = 64
# Rows that a cell should hold; above CROWDED times its share of all rows it is cut again.
CELL_ROWS = 250_000
CROWDED = 4


def as_number(df: DataFrame, column: str) -> Column | None:
    """The column as a whole number that sorts as it does, None for other types."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        return F.expr(f"timestampdiff(MICROSECOND, {epoch}, `{column}`)")
    return None


def has_grid(df: DataFrame, order: Sequence[str]) -> bool:
    return all(as_number(df, c) is not None for c in order)


def grid_position(
    df: DataFrame, order: Sequence[str], name: str = "position", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Adds each row's place (from 1) in `order`, NULLs first; rows are shuffled once.

    Runs small jobs while the plan is made: one for the bounds, and one for each round of
    counts. Rows that agree in all of `order` stay in one cell, whatever their number.
    """
    total = df.count()
    numbers = [as_number(df, c) for c in order]
    cells = min(CELLS, -(-total // cell_rows))
    limit = max(cell_rows, CROWDED * total // CELLS)
    widths = _Widths(df, numbers, max(1, cells))
    celled = df.withColumn("_cell", F.array(widths.cell()))
    counts = _counts(celled)
    settled: dict[tuple, int] = {}
    while True:
        crowded = [c for c, n in counts.items() if n > limit]
        settled |= {c: n for c, n in counts.items() if n <= limit}
        if not crowded:
            break
        finer = min(FINER, -(-max(counts[c] for c in crowded) * CROWDED // cell_rows))
        # As few rows as there are crowded cells.
        few = F.broadcast(_cell_table(df, crowded, "_crowded"))
        inside = celled.join(few, F.col("_cell") == F.col("_crowded"), "left_semi")
        if not widths.narrow(inside, finer):
            settled |= {c: counts[c] for c in crowded}
            break
        is_crowded = F.col("_crowded").isNotNull()
        longer = F.concat("_cell", F.array(widths.cell()))
        celled = (
            celled.join(few, F.col("_cell") == F.col("_crowded"), "left")
            .withColumn("_cell", F.when(is_crowded, longer).otherwise(F.col("_cell")))
            .drop("_crowded")
        )
        counts = _counts(
            inside.withColumn("_cell", F.concat("_cell", F.array(widths.cell())))
        )
    before, rows = 0, []
    for cell in sorted(settled, key=lambda c: [(v is not None, v or 0) for v in c]):
        rows.append((list(cell), before))
        before += settled[cell]
    offsets = df.sparkSession.createDataFrame(rows, "_of array<bigint>, _before bigint")
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(*order))
    return (
        celled.join(F.broadcast(offsets), F.col("_cell") == F.col("_of"))
        .withColumn(name, F.col("_before") + inside)
        .drop("_cell", "_of", "_before")
    )


class _Widths:
    """Which order column cells are cut by, and how wide they are."""

    def __init__(self, df: DataFrame, numbers: list[Column], cells: int):
        self.numbers, self.at = numbers, 0
        self.width = self._width(df, cells)

    def _width(self, df: DataFrame, cells: int) -> int:
        number = self.numbers[self.at]
        low, high = df.agg(F.min(number), F.max(number)).first()
        return ((high or 0) - (low or 0)) // cells + 1

    def cell(self) -> Column:
        # Whole division keeps the order and cannot overflow.
        width = min(self.width, 2**63 - 1)
        number = self.numbers[self.at]
        divided = F.call_function("div", number, F.lit(width).cast("long"))
        return divided if width > 1 else number

    def narrow(self, crowded: DataFrame, finer: int) -> bool:
        """Cuts finer, or goes on to the next column; False if there is none."""
        if self.width > 1:
            self.width = max(1, self.width // max(2, finer))
            return True
        self.at += 1
        if self.at == len(self.numbers):
            return False
        self.width = self._width(crowded, max(2, finer))
        return True


def _counts(celled: DataFrame) -> dict[tuple, int]:
    counted = celled.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
    return {tuple(r["_cell"]): r["n"] for r in counted.collect()}


def _cell_table(df: DataFrame, cells: list[tuple], name: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(list(c),) for c in cells], f"{name} array<bigint>")
