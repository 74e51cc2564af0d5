"""Questions to the session: shared folder, size of a side table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that every executor can reach.

    Lies below ``spark.checkpoint.dir``, or in the warehouse where that is not set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_runs")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


# No value of a collected side table is longer than this.
MAX_VALUE_CHARS = 1000


def rows_if_small(table: DataFrame, max_rows: int) -> list[Row] | None:
    """The rows of a side table, or None when it has more, or a text above the limit.

    At most ``max_rows + 1`` rows with texts cut at the limit ever reach the
    driver, however large the table is.
    """
    texts = [f.name for f in table.schema if f.dataType.typeName() == "string"]
    cut = [
        F.left(F.col(f"`{c}`"), F.lit(MAX_VALUE_CHARS + 1)).alias(c) if c in texts
        else F.col(f"`{c}`")
        for c in table.columns
    ]
    rows = table.select(*cut).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    if any(len(r[c] or "") > MAX_VALUE_CHARS for r in rows for c in texts):
        return None
    return rows
