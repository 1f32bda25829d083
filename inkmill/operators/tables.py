"""Grids of cells: dense rows from sparse cells, and markdown tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import clean_controls

MAX_ROWS = 2000
NOTHING = "(empty sheet)"


def dense_rows(cells: DataFrame, by: list[str]) -> DataFrame:
    """(by, row, values): rows of a sheet as arrays, gaps as empty text; of equal positions the last in reading order (ord) holds."""
    last = cells.groupBy(*by, "row", "col").agg(F.max_by("value", "ord").alias("value"))
    rows = last.groupBy(*by, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("m"))
    width = F.array_max(F.map_keys("m"))
    return rows.select(*by, "row", F.transform(F.sequence(F.lit(0), width), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(""))).alias("values"))


def table_text(rows: Column) -> Column:
    """A markdown table of an array of rows: rows without text are left out, all are padded to the widest, the first is the head."""
    kept = F.filter(rows, lambda r: F.exists(r, lambda c: F.trim(c) != ""))
    width = F.array_max(F.transform(kept, lambda r: F.size(r)))
    clean = F.transform(kept, lambda r: F.transform(r, lambda c: F.replace(F.regexp_replace(clean_controls(c), r"\r?\n", " "), F.lit("|"), F.lit("\\|"))))
    padded = F.transform(clean, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
    lines = F.transform(padded, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), width))
    return F.when(F.size(kept) == 0, F.lit(NOTHING)).otherwise(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, 1_000_000)), "\n"))
