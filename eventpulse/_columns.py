"""Small helpers shared by the column expressions."""

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def as_column(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col

