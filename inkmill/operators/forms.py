"""Transforms of template documents: fill, split, strip, clean and list placeholders, on the text of their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import xml_escape

#: The forms of paragraphs, tables, layout caches, runs, unfilled lines and placeholders in the parts. Fixed values.
PARAGRAPH = r"(?s)<hp:p\b[^>]*>.*?</hp:p>"
TABLE = r"(?s)<hp:tbl\b.*?</hp:tbl>"
LAYOUT = r"(?s)<hp:linesegarray\b[^>]*/>|<hp:linesegarray\b.*?</hp:linesegarray>"
RUN = r"<hp:t\b[^>]*>([^<]*)</hp:t>"
EMPTY = r"^\s*[ㅇ○\-•·]*\s*(?:\{\{[^}]+\}\}\s*)+\s*$"
KEY = r"\{\{([^}]+)\}\}"


def fill(text: Column, entries: list[tuple[str, str]]) -> Column:
    """Literal replacement in the order of the entries; what a value brings in is replaced again by later entries."""
    for key, value in entries:
        text = F.replace(text, F.lit(key), xml_escape(F.lit(value)))
    return text


def occurrences(text: Column, key: str) -> Column:
    """How often a literal stands in a text, without overlaps."""
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(key), F.lit("")))) / len(key)).cast("int")


def strip_blocks(text: Column, pattern: str) -> Column:
    """struct(text, n): the text without the blocks, and their number."""
    return F.struct(F.regexp_replace(text, pattern, "").alias("text"), F.regexp_count(text, F.lit(pattern)).alias("n"))


def outside(text: Column, mask: str, change) -> Column:
    """A change of the text outside the masked blocks; the blocks stay as they are, in place."""
    mark = "\x00"
    kept = F.regexp_extract_all(text, F.lit(mask), F.lit(0))
    pieces = F.split(F.regexp_replace(text, mask, mark), mark)
    changed = F.transform(pieces, change)
    return F.array_join(F.transform(F.arrays_zip(changed.alias("p"), F.concat(kept, F.array(F.lit(""))).alias("k")), lambda z: F.concat(z["p"], z["k"])), "")


def clean_unfilled(text: Column, paragraph: str = PARAGRAPH, mask: str = TABLE, run: str = RUN, empty: str = EMPTY) -> Column:
    """The text without the paragraphs outside tables that hold nothing but bullets and placeholders."""

    def change(piece: Column) -> Column:
        found = F.regexp_extract_all(piece, F.lit(paragraph), F.lit(0))
        between = F.split(F.regexp_replace(piece, paragraph, "\x01"), "\x01")

        def kept(p: Column) -> Column:
            said = F.trim(F.array_join(F.regexp_extract_all(p, F.lit(run), F.lit(1)), ""))
            return F.when((said != "") & said.rlike(empty), F.lit("")).otherwise(p)

        both = F.arrays_zip(between.alias("b"), F.concat(F.transform(found, kept), F.array(F.lit(""))).alias("f"))
        return F.array_join(F.transform(both, lambda z: F.concat(z["b"], z["f"])), "")

    return outside(text, mask, change)


_FIRST = r"(?s)^(.*?<hp:t\b[^>]*>)([^<]*\n[^<]*)(</hp:t>.*)$"


def split_lines(text: Column) -> Column:
    """Each paragraph whose first multi-line run has n lines becomes n paragraphs, one line in each; all else is copied into each."""

    def clones(p: Column) -> Column:
        lines = F.split(F.regexp_extract(p, _FIRST, 2), "\n")
        made = F.array_join(F.transform(lines, lambda x: F.concat(F.regexp_extract(p, _FIRST, 1), x, F.regexp_extract(p, _FIRST, 3))), "")
        return F.when(p.rlike(_FIRST), made).otherwise(p)

    found = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    between = F.split(F.regexp_replace(text, PARAGRAPH, "\x01"), "\x01")
    both = F.arrays_zip(between.alias("b"), F.concat(F.transform(found, clones), F.array(F.lit(""))).alias("f"))
    return F.array_join(F.transform(both, lambda z: F.concat(z["b"], z["f"])), "")


def multi_line_paragraphs(text: Column) -> Column:
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: p.rlike(_FIRST)))


def placeholders(docs: DataFrame, id_col: str, text_col: str, pattern: str = KEY) -> DataFrame:
    """(id, place, key, at, label): distinct keys in order of first sight, where they stand, and the last [label] of the 500 characters before.

    The positions come from the lengths of the pieces between the keys."""
    t = docs.select(F.col(id_col), F.col(text_col).alias("t")).withColumn("keys", F.regexp_extract_all("t", F.lit(pattern), F.lit(1)))
    t = t.withColumn("whole", F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).withColumn("between", F.split(F.regexp_replace("t", pattern, "\x01"), "\x01")).where("size(keys) > 0")
    e = t.select(id_col, "t", "keys", "whole", "between", F.posexplode("keys").alias("i", "key")).where(F.array_position("keys", F.col("key")) == F.col("i") + 1)
    at = F.aggregate(F.slice("between", 1, F.col("i") + 1), F.lit(0), lambda a, x: a + F.char_length(x)) + F.aggregate(F.slice("whole", 1, F.col("i")), F.lit(0), lambda a, x: a + F.char_length(x))
    e = e.select(id_col, "t", "i", "key", at.alias("at"))
    before = F.substring(F.col("t"), F.greatest(F.col("at") - 499, F.lit(1)), F.least(F.col("at"), F.lit(500)))
    label = F.try_element_at(F.regexp_extract_all(before, F.lit(r"\[([^\]]+)\]"), F.lit(1)), F.lit(-1))
    return e.select(id_col, F.col("i").alias("place"), "key", "at", label.alias("label"))


def deepest(points: DataFrame, intervals: DataFrame, key: str, width: int) -> DataFrame:
    """points (key, at) with the depth of the deepest interval (key, s, e, depth) that holds them, s <= at < e; 0 if none.

    The range join runs as an equal join on the buckets of ``width`` positions that an interval reaches into."""
    spread = intervals.where("e > s").select(key, "s", "e", "depth", F.explode(F.sequence(F.floor(F.col("s") / width), F.floor((F.col("e") - 1) / width))).alias("b"))
    p = points.withColumn("b", F.floor(F.col("at") / width))
    hit = p.join(spread, [key, "b"]).where("s <= at AND at < e").groupBy(*points.columns).agg(F.max("depth").alias("depth"))
    return points.join(hit, points.columns, "left").na.fill(0, ["depth"])


def template_lines(keys: DataFrame, id_col: str, hints: DataFrame) -> DataFrame:
    """(id, template): a fill-in template of the keys of a form: outer keys first, then nested ones, each with the best comment there is.

    keys: id, place, key, depth, label. hints: id, key, hint. A comment is the hint, else the label, else the depth."""
    j = keys.join(hints, [id_col, "key"], "left")
    comment = F.coalesce("hint", "label", F.concat(F.lit("depth "), F.col("depth").cast("string")))
    line = F.concat(F.lit('"'), F.col("key"), F.lit('": ""  # '), comment)
    return j.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((F.col("depth") > 0).alias("nested"), "place", line.alias("line")))), lambda x: x["line"]), "\n").alias("template"))


def filled(text: Column, entries: list[tuple[str, str]], split: bool = True, strip: bool = True) -> Column:
    """A form filled, then with its lines split into paragraphs, then without its layout cache."""
    text = fill(text, entries)
    text = split_lines(text) if split else text
    return F.regexp_replace(text, LAYOUT, "") if strip else text


def missing_keys(text: Column, entries: list[tuple[str, str]]) -> Column:
    """The keys of the entries that a text doesn't hold."""
    return F.filter(F.array(*(F.lit(k) for k, _ in entries)), lambda k: ~F.contains(text, k))


def key_counts(keys: DataFrame, id_col: str, hints: DataFrame) -> DataFrame:
    """(id, keys, outer, nested, matched): how many keys a form has, outside and inside of tables, and how many the guide explains."""
    j = keys.join(hints.select(id_col, "key").distinct().withColumn("_known", F.lit(True)), [id_col, "key"], "left")
    return j.groupBy(id_col).agg(F.count("*").alias("keys"), F.count_if(F.col("depth") == 0).alias("outer"), F.count_if(F.col("depth") > 0).alias("nested"), F.count_if(F.col("_known")).alias("matched"))
