"""Scalar functions on text, paths and times, as expressions of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def even_lines(c: Column) -> Column:
    """Text with LF line ends only."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def clean_controls(c: Column) -> Column:
    """Text without C0 controls but tab, LF and CR, without DEL and byte order marks."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{FEFF}]", "")


def slug(c: Column, most: int = 50) -> Column:
    """A name for files: white space to hyphens, reserved signs dropped, ends trimmed, then cut; no-subject if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""), r"\s+", "-")
    s = F.regexp_replace(F.regexp_replace(s, r'[\\/:*?"<>|]', ""), r"^[-. ]+|[-. ]+$", "")
    return F.coalesce(F.nullif(F.substring(s, 1, most), F.lit("")), F.lit("no-subject"))


def xml_escape(c: Column) -> Column:
    """& first, then < and >."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def clock(seconds: Column) -> Column:
    """mm:ss of seconds, with the hour before it only where there is one."""
    s = F.floor(seconds).cast("bigint")
    short = F.concat(F.lpad(F.floor((s % 3600) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))
    return F.when(s >= 3600, F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), short)).otherwise(short)


def column_index(ref: Column) -> Column:
    """The position of a spreadsheet column from its letters, from 0; 0 without letters."""
    letters = F.split(F.upper(F.regexp_extract(ref, r"^([A-Za-z]+)", 1)), "")
    used = F.filter(letters, lambda x: x != "")
    return F.greatest(F.aggregate(used, F.lit(0), lambda a, x: a * 26 + F.ascii(x) - 64) - 1, F.lit(0))


def url_base64(c: Column) -> Column:
    """Text of URL-safe base64, with or without padding; null if it is none. Bytes that are no UTF-8 are replaced."""
    plain = F.translate(F.regexp_replace(c, "=+$", ""), "-_", "+/")
    padded = F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4))))
    return F.validate_utf8(F.make_valid_utf8(F.try_to_binary(padded, F.lit("base64")).cast("string")))


def loose_json(c: Column) -> Column:
    """A variant of JSON text: as a whole, else of what lies between its first { and last }."""
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))))


def needs_review(c: Column) -> Column:
    """False only if the first line of a reply says STATUS: ok."""
    return ~F.coalesce(F.regexp_extract(c, r"^\s*STATUS:\s*(\w+)", 1) == "ok", F.lit(False))


def reply_subject(c: Column) -> Column:
    """A subject with Re: before it, once."""
    s = F.coalesce(c, F.lit(""))
    return F.when(F.lower(s).startswith("re:"), s).otherwise(F.concat(F.lit("Re: "), s))


def label_query(c: Column) -> Column:
    """A search for a label: hyphens for blanks where it holds a +, else in quotes."""
    return F.when(F.contains(c, F.lit("+")), F.concat(F.lit("label:"), F.replace(c, F.lit(" "), F.lit("-")))).otherwise(F.concat(F.lit('label:"'), c, F.lit('"')))


def seoul(c: Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """A time in Seoul, from ISO text; empty if it can't be read."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(F.try_to_timestamp(c), "Asia/Seoul"), pattern), F.lit(""))


def age_days(c: Column, now: str) -> Column:
    return (F.lit(now).cast("timestamp").cast("double") - c.cast("timestamp").cast("double")) / 86400


def extension(path: Column) -> Column:
    """The extension of a file in lower case, without its dot."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def parse_dir(path: Column) -> Column:
    """The folder beside a file that holds what was parsed from it."""
    return F.concat(path, F.lit("_parse"))


def front_matter(text: Column) -> Column:
    """key/value entries of the block between the first two --- lines; the last of equal keys holds. Null without a block."""
    block = F.regexp_extract(text, r"(?s)^---\n(.*?)\n---", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q.key == p.key))
    return F.when(block != "", F.map_from_entries(last))


def all_day_end(day: Column) -> Column:
    """The exclusive end of an all-day event: the next day; text that is no date stays."""
    return F.coalesce(F.date_add(F.try_to_date(day), 1).cast("string"), day)
