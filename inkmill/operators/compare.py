"""Comparison of two parses of one document: headings, paragraphs, tables and numbers of its markdown.

Everything but the multiset of numbers is computed within a row by expressions of columns; the numbers of both
parses meet in one full outer join of counts. Defined results: a null markdown is an empty one; two empty parses agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.text import even_lines

#: Thresholds of the verdict. Fixed values.
HEADINGS, PARAGRAPHS, TABLES, NUMBERS = 0.8, 0.2, 0.8, 0.95
LISTED = 10

#: The forms of tables, headings, breaks and cells in markdown. Fixed values.
HTML_TABLE = r"(?s)<table.*?</table>"
PIPE_TABLE = r"(?m)^\|[^\n]*\n\|[ \t\-:|]+\|[ \t]*(?:\n\|[^\n]*)*"
HEADING = r"(?m)^#+[ \t]+([^\n]*)"
BREAKS = r"(?m)^(?:#+[ \t]+[^\n]*|\x{E000}[^\n]*)$"
#: Stands where a table was taken out.
PLACE = "\ue000"
CELL = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"


def with_features(records: DataFrame) -> DataFrame:
    """(rec_id, headings, n_paragraphs, n_tables, cells) of records with markdown, one row for each row.

    Done in steps whose columns are used several times, so that each pattern runs once over a text."""
    t = records.select("rec_id", F.rtrim(even_lines(F.coalesce("markdown", F.lit("")))).alias("text"))
    t = t.select("rec_id", F.regexp_extract_all("text", F.lit(HTML_TABLE), F.lit(0)).alias("html"), F.regexp_replace("text", HTML_TABLE, PLACE).alias("masked"))
    t = t.select("rec_id", "html", F.regexp_extract_all("masked", F.lit(PIPE_TABLE), F.lit(0)).alias("pipes"), F.regexp_replace("masked", PIPE_TABLE, "\n\n").alias("flow"))
    blocks = F.split(F.regexp_replace("flow", BREAKS, "\n\n"), r"\n[ \t]*\n")
    paragraphs = F.filter(blocks, lambda b: b.rlike(r"\S"))
    headings = F.transform(F.regexp_extract_all("flow", F.lit(HEADING), F.lit(1)), lambda x: F.trim(x))
    html_cells = F.flatten(F.transform("html", lambda x: F.transform(F.regexp_extract_all(x, F.lit(CELL), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", "")))))

    def rows(x: Column) -> Column:
        kept = F.filter(F.split(x, "\n"), lambda r, i: i != 1)
        return F.flatten(F.transform(kept, lambda r: F.transform(F.split(F.regexp_replace(F.rtrim(r), r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c))))

    cells = F.concat(html_cells, F.flatten(F.transform("pipes", rows)))
    return t.select("rec_id", headings.alias("headings"), F.size(paragraphs).alias("n_paragraphs"), (F.size("html") + F.size("pipes")).alias("n_tables"), cells.alias("cells"))


def numeric(cells: Column) -> Column:
    """The cells that are numbers, without grouping commas, white space and percent signs."""
    return F.filter(F.transform(cells, lambda c: F.regexp_replace(c, r"[,\s%]", "")), lambda c: c.rlike(r"^-?\d+(\.\d+)?$"))


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.when(F.greatest(a, b) == 0, F.lit(empty)).otherwise(F.least(a, b) / F.greatest(a, b))


def profiles(records: DataFrame) -> DataFrame:
    """(rec_id, headings, n_paragraphs, n_tables, numbers) of parse records, each record once."""
    f = with_features(records)
    slim = f.select("rec_id", F.array_distinct("headings").alias("headings"), "n_paragraphs", "n_tables", numeric(F.col("cells")).alias("numbers"))
    return slim.dropDuplicates(["rec_id"])


def number_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """(rec_id, value, n_a, n_b): how often each number stands in either profile."""
    left, right = (p.select("rec_id", F.explode("numbers").alias("value")).groupBy("rec_id", "value").agg(F.count("*").alias(n)) for p, n in ((a, "n_a"), (b, "n_b")))
    both = left.join(right, ["rec_id", "value"], "full")
    return both.na.fill(0, ["n_a", "n_b"])


def _of(a: DataFrame, b: DataFrame) -> DataFrame:
    """The records of ``a`` that ``b`` has too; others needn't be read closely."""
    return a.select("rec_id", "markdown").join(b.select("rec_id").distinct(), "rec_id", "left_semi")


def metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row for each record that both sides have: four ratios, their counts and the verdict. Ratios stay unrounded."""
    pa_, pb = profiles(_of(a, b)), profiles(b)
    sides = pa_.select("rec_id", *(F.col(c).alias(f"{c}_a") for c in pa_.columns[1:])).join(pb.select("rec_id", *(F.col(c).alias(f"{c}_b") for c in pb.columns[1:])), "rec_id")
    shared = number_counts(sides.select("rec_id", F.col("numbers_a").alias("numbers")), sides.select("rec_id", F.col("numbers_b").alias("numbers"))).groupBy("rec_id").agg(F.sum(F.least("n_a", "n_b")).alias("shared"))
    j = sides.join(shared, "rec_id", "left")
    ha, hb = F.size("headings_a"), F.size("headings_b")
    overlap = F.when(F.greatest(ha, hb) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect("headings_a", "headings_b")) / F.greatest(ha, hb))
    pa_n, pb_n = F.col("n_paragraphs_a"), F.col("n_paragraphs_b")
    delta = F.when(F.greatest(pa_n, pb_n) == 0, F.lit(0.0)).otherwise(F.abs(pa_n - pb_n) / F.greatest(pa_n, pb_n))
    na, nb = F.size("numbers_a"), F.size("numbers_b")
    numbers = F.when(F.greatest(na, nb) == 0, F.lit(1.0)).otherwise(F.coalesce("shared", F.lit(0)) / F.greatest(na, nb))
    out = j.select("rec_id", overlap.alias("heading_overlap"), delta.alias("paragraph_delta"), _ratio(F.col("n_tables_a"), F.col("n_tables_b"), 1.0).alias("table_match"), numbers.alias("numeric_match"), ha.alias("headings_a"), hb.alias("headings_b"), pa_n.alias("paragraphs_a"), pb_n.alias("paragraphs_b"), F.col("n_tables_a").alias("tables_a"), F.col("n_tables_b").alias("tables_b"), na.alias("numbers_a"), nb.alias("numbers_b"))
    agree = (F.col("heading_overlap") >= HEADINGS) & (F.col("paragraph_delta") <= PARAGRAPHS) & (F.col("table_match") >= TABLES) & (F.col("numeric_match") >= NUMBERS)
    return out.withColumn("verdict", F.when(agree, "agree").otherwise("diverge"))


def mismatches(a: DataFrame, b: DataFrame, most: int = LISTED) -> DataFrame:
    """(rec_id, side, value, surplus, place): the numbers of one side that the other lacks, the most frequent first; ties by side and value."""
    n = number_counts(profiles(_of(a, b)), profiles(_of(b, a)))
    sides = n.select("rec_id", "value", F.expr("CASE WHEN n_a > n_b THEN 'a_only' ELSE 'b_only' END").alias("side"), F.abs(F.col("n_a") - F.col("n_b")).alias("surplus")).where("surplus > 0")
    place = F.row_number().over(Window.partitionBy("rec_id").orderBy(F.desc("surplus"), "side", "value"))
    return sides.withColumn("place", place).where(F.col("place") <= most)


def heading_differences(a: DataFrame, b: DataFrame, most: int = LISTED) -> DataFrame:
    """(rec_id, side, heading, place): the first headings, in code point order, that one side alone has."""
    j = profiles(_of(a, b)).select("rec_id", F.col("headings").alias("x")).join(profiles(b).select("rec_id", F.col("headings").alias("y")), "rec_id")
    firsts = [j.select("rec_id", F.lit(side).alias("side"), F.posexplode(F.slice(F.array_sort(F.array_except(p, q)), 1, most)).alias("place", "heading")) for side, p, q in (("a", "x", "y"), ("b", "y", "x"))]
    return firsts[0].unionByName(firsts[1]).withColumn("place", F.col("place") + 1)
