"""Readers of notes, markers, guides and answers: text in, entries out.

Defined results: null text has no entries; of equal keys the last holds, of equal codes the last note by path; lines
without the sign that parts key and value are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys under which a service's answer may hold its list, in order. Fixed values.
LIST_KEYS = ("files", "items", "results", "result", "data")
HEAD_CHARS = 2048
MEETING = r"([a-z]{3}-[a-z]{4}-[a-z]{3})"
NO_SPEECH = "(no speech)"


def entries(text: Column) -> Column:
    """key/value entries of lines such as `key: value`; the last of equal keys."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"^\s*[^:]+:\s"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def guide(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, hint): rows of markdown tables whose first cell is a `{{key}}` in back ticks and whose third is not empty; the last of equal keys."""
    lines = docs.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    cells = F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\|")
    found = lines.select(id_col, "pos", F.regexp_extract(F.trim(F.try_element_at(cells, F.lit(1))), r"^`\{\{([^}]+)\}\}`$", 1).alias("key"), F.trim(F.coalesce(F.try_element_at(cells, F.lit(3)), F.lit(""))).alias("hint"))
    return found.where("key != '' AND hint != ''").groupBy(id_col, "key").agg(F.max_by("hint", "pos").alias("hint"))


def first_list(answer: Column) -> Column:
    """The first list of an answer: itself, or under the first of LIST_KEYS that holds one; as an array of variants."""
    v = F.try_parse_json(answer)
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *(F.try_variant_get(v, f"$.{k}", "array<variant>") for k in LIST_KEYS))


def meetings(notes: DataFrame) -> DataFrame:
    """(code, note): meeting codes of the heads of notes (path, text); nothing in hidden folders."""
    head = F.substring("text", 1, HEAD_CHARS)
    code = F.regexp_extract(head, rf"(?m)^meet_link:\s*\S*?/{MEETING}", 1)
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    seen = notes.where(~F.col("path").rlike(r"(^|/)\.[^/]+/")).select(code.alias("code"), "path", stem.alias("note")).where("code != ''")
    return seen.groupBy("code").agg(F.max_by("note", "path").alias("note"))


def recording_name(name: Column, note: Column, suffix: str) -> Column:
    """date_note_suffix.ext of a recording whose name holds a meeting's code and, after it, a date; without a note the code stands
    for it. Any other name keeps its words, joined by _."""
    form = rf"{MEETING}.*?(\d{{4}}-\d{{2}}-\d{{2}})"
    code, day = F.regexp_extract(name, form, 1), F.regexp_extract(name, form, 2)
    ext = F.coalesce(F.nullif(F.regexp_extract(name, r"[^.](\.[^./]*)$", 1), F.lit("")), F.lit(".mp4"))
    return F.when(code == "", F.replace(name, F.lit(" "), F.lit("_"))).otherwise(F.concat(day, F.lit("_"), F.coalesce(note, code), F.lit(f"_{suffix}"), ext))


def named_recordings(recordings: DataFrame, index: DataFrame, suffix: str) -> DataFrame:
    """``recordings`` (name, ...) with their target names: the note of the meeting's code, if any has it."""
    keyed = recordings.withColumn("code", F.regexp_extract("name", MEETING, 1))
    return keyed.join(index, "code", "left").withColumn("target", recording_name(F.col("name"), F.col("note"), suffix)).drop("code", "note")


def transcript(segments: Column) -> Column:
    """Lines [mm:ss] text of an array of struct(start, text); blank segments are left out."""
    from inkmill.functions.text import clock

    said = F.filter(segments, lambda s: F.trim(s["text"]) != "")
    lines = F.transform(said, lambda s: F.concat(F.lit("["), clock(s["start"]), F.lit("] "), F.trim(s["text"])))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(NO_SPEECH)


def yaml_values(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, value): scalars of front matter and of the first yaml block, as text; the block's win over the front matter's.

    Values are typed as YAML types them and then written as text: truth values True and False, dates as ISO, null as
    empty. A block that is no mapping or no YAML has no rows."""
    import pandas as pd

    def run(frames):
        import yaml

        for f in frames:
            rows = []
            for key, text in zip(f["id"], f["t"], strict=True):
                found = {}
                for form in (r"\A---\n(.*?)\n---", r"```yaml\n(.*?)\n```"):
                    import re

                    m = re.search(form, text or "", re.S)
                    try:
                        value = yaml.safe_load(m[1]) if m else None
                    except (yaml.YAMLError, ValueError):
                        value = None
                    if isinstance(value, dict):
                        found |= {str(k): "" if v is None else str(v) for k, v in value.items() if not isinstance(v, (dict, list))}
                rows += [(key, k, v) for k, v in found.items()]
            yield pd.DataFrame(rows, columns=["id", "key", "value"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInPandas(run, f"id {kind}, key string, value string").withColumnRenamed("id", id_col)


def clean_converted(md: Column) -> Column:
    """Markdown of a converted document without column groups, and without a table of one cell around it all."""
    s = F.regexp_replace(md, r"(?s)<colgroup>.*?</colgroup>\n?", "")
    return F.regexp_replace(s, r"(?s)^\s*<table>\s*(?:<tbody>\s*)?<tr>\s*<td>((?:(?!<td).)*)</td>\s*</tr>\s*(?:</tbody>\s*)?</table>\s*$", "$1")


def counted_failures(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """(item, fails, at, reason) of tab-separated lines of two fields or more; a count that is no number is null."""
    p = F.split(text_col, "\t")
    return lines.where(F.size(p) >= 2).select(p[0].alias("item"), F.expr(f"try_cast(split({text_col}, '\\t')[1] AS int)").alias("fails"), F.try_element_at(p, F.lit(3)).alias("at"), F.try_element_at(p, F.lit(4)).alias("reason"))
