"""Which work is due: candidates, gates, ledgers, caps and budgets over files and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import base_name, extension
from inkmill.plans.ranked import with_rank, with_sum_before

#: Formats that are converted before parsing, and their target. Fixed values.
CONVERTED = {"hwp": "docx", "hwpx": "docx", "doc": "docx", "rtf": "docx", "odt": "docx", "ppt": "pptx", "odp": "pptx", "xls": "xlsx", "ods": "xlsx"}
#: Lanes in the order in which they are worked off. Fixed values.
LANES = {"hwp": 1, "hwpx": 1, "xls": 2, "xlsx": 2, "pdf": 3, "docx": 3, "pptx": 3, "doc": 3, "png": 4, "jpg": 4, "jpeg": 4, "m4a": 5, "mp3": 5, "wav": 5}


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    found = F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)
    return found if default is None else F.coalesce(found, default)


def candidates(files: DataFrame, extensions: list[str]) -> DataFrame:
    """(path, inbox, place): files with one of the extensions as written, inbox first, each path once; nothing under a parse folder or held back."""
    kept = files.where(F.regexp_extract("path", r"\.([^./]+)$", 1).isin(extensions)).where(~F.contains("path", F.lit("_parse/")) & ~F.contains("path", F.lit("/_hold/")))
    once = kept.select("path", F.contains("path", F.lit("00_inbox/")).alias("inbox")).distinct()
    return with_rank(once, [F.desc("inbox"), F.asc("path")], "place")


def route(path: Column) -> Column:
    """The format that a file is parsed as."""
    return lookup(extension(path), CONVERTED, extension(path))


def bulk(path: Column, length: Column, pages: Column, pattern: str, pages_most: int = 100, mb_most: int = 20, named_pages: int = 40, named_mb: int = 8) -> Column:
    """Whether a file is too large for the regular run: by pages where they are known, else by whole megabytes; a name that says so lowers the limit."""
    named = base_name(path).rlike("(?i)" + pattern)
    mb = F.floor(length / 1048576)
    by_pages = (pages >= pages_most) | (named & (pages >= named_pages))
    by_size = (mb >= mb_most) | (named & (mb >= named_mb))
    return F.when(pages.isNotNull(), by_pages).otherwise(F.coalesce(by_size, F.lit(False)))


def states(files: DataFrame, done: DataFrame, failed: DataFrame, pattern: str) -> DataFrame:
    """(path, state): done, bulk, failed or attempt, in that order of precedence. done and failed have a column path."""
    j = files.select("path", "length", "pages").distinct().join(done.select("path").distinct().withColumn("is_done", F.lit(True)), "path", "left").join(failed.select("path").distinct().withColumn("is_failed", F.lit(True)), "path", "left")
    state = F.when(F.col("is_done"), "done").when(bulk(F.col("path"), F.col("length"), F.col("pages"), pattern), "bulk").when(F.col("is_failed"), "failed").otherwise("attempt")
    return j.select("path", state.alias("state")).groupBy("path").agg(F.min(F.struct(F.array_position(F.array(*map(F.lit, ("done", "bulk", "failed", "attempt"))), F.col("state")).alias("k"), "state")).alias("s")).select("path", "s.state")


def admitted(attempts: DataFrame, cap: int) -> DataFrame:
    """(path, inbox, lane): all attempts of the inbox, and the first ``cap`` of the backlog in order of lane and path."""
    marked = attempts.select("path", F.contains("path", F.lit("00_inbox/")).alias("inbox"), lookup(extension(F.col("path")), LANES, F.lit(9)).alias("lane"))
    return marked.where("inbox").unionByName(marked.where("NOT inbox").orderBy("lane", "path").limit(cap))


def within_budget(items: DataFrame, order: list[Column], cost: Column, cap: float) -> DataFrame:
    """The items that begin while what was spent before them is below the cap; the last one may overshoot."""
    return with_sum_before(items, order, cost, "spent_before").where(F.col("spent_before") < cap)


def not_in_ledger(items: DataFrame, ledger: DataFrame, key: Column) -> DataFrame:
    """Items whose key the ledger doesn't hold; blank ledger lines hold nothing."""
    known = ledger.select(F.trim("ledger_key").alias("_key")).where("_key != ''").distinct()
    return items.withColumn("_key", key).join(known, "_key", "left_anti").drop("_key")


def unique_names(files: DataFrame, name: str, order: str) -> DataFrame:
    """``files`` with a column dest: equal names get _1, _2, ... before the extension, in order."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    stem, ext = F.regexp_extract(F.col(name), r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(F.col(name), r"^(.*?)(\.[^.]*)?$", 2)
    return files.withColumn("dest", F.when(n == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), n.cast("string"), ext)))


def prune_copies(items: DataFrame, key: str, content: str) -> DataFrame:
    """(key, kept): items whose content another item with a smaller key has too."""
    hashed = items.where(F.col(content).isNotNull()).select(key, F.sha2(content, 256).alias("h"))
    first = hashed.groupBy("h").agg(F.min(key).alias("kept"), F.count("*").alias("n")).where("n > 1")
    return hashed.join(first, "h").where(F.col(key) != F.col("kept")).select(key, "kept")


def failures(errors: DataFrame, give_up: int = 2) -> DataFrame:
    """(source, fails, last_seen, reason, given_up): distinct failures of each source; the reason of the last, ties by reason."""
    once = errors.where("reason IS NOT NULL").distinct()
    last = F.max(F.struct("seen_at", "reason"))
    return once.groupBy("source").agg(F.count("*").alias("fails"), last.alias("l")).select("source", "fails", F.col("l.seen_at").alias("last_seen"), F.col("l.reason").alias("reason"), (F.col("fails") >= give_up).alias("given_up"))


def latest_markers(errors: DataFrame) -> DataFrame:
    """(source, stage, host, reason, seen_at): the last marker of each source and stage; markers with nothing but a source are left out."""
    real = errors.where("stage IS NOT NULL")
    return real.groupBy("source", "stage").agg(F.max(F.struct("seen_at", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("reason", F.lit("")).alias("reason"))).alias("m")).select("source", "stage", "m.host", "m.reason", "m.seen_at")


#: What shows that a file of a lane is done. Fixed values.
ARTEFACTS = {"hwp": ("refined.md",), "hwpx": ("refined.md",), "xls": ("refined.md",), "xlsx": ("refined.md",), "pdf": ("diff.json",), "png": ("ocr.json",), "jpg": ("ocr.json",), "jpeg": ("ocr.json",), "m4a": ("refined.md",), "mp3": ("refined.md",), "wav": ("refined.md",)}
OTHER_ARTEFACTS = ("docling.json", "refined.md")
#: Suffixes of recordings that are not taken up as notes. Fixed values.
RECORDINGS = r"(?i)\.(m4a|mp3|wav|ogg|opus|aac|amr)$"


def is_done(path: Column, artefacts: Column) -> Column:
    """Whether one of the artefacts that a file's format asks for is there; artefacts is an array of names."""
    table = F.create_map(*(x for k, v in ARTEFACTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    asked = F.coalesce(F.element_at(table, extension(path)), F.array(*map(F.lit, OTHER_ARTEFACTS)))
    return F.coalesce(F.arrays_overlap(asked, artefacts), F.lit(False))


def due(gated: DataFrame, retry: bool = False) -> DataFrame:
    """Rows whose state asks for an attempt; failed ones too if they are to be tried again."""
    return gated.where(F.col("state").isin("attempt", "failed") if retry else F.col("state") == "attempt")


def phases(items: DataFrame) -> DataFrame:
    """``items`` with the phase they are due in: refine, take_up, renew or none. Columns: action, taken_up, ready, path."""
    phase = F.when(F.col("action").isin("promote", "refine"), "refine").when(~F.coalesce("taken_up", F.lit(False)) & ~F.coalesce(F.col("path").rlike(RECORDINGS), F.lit(False)), "take_up").when(F.coalesce("ready", F.lit(False)), "renew").otherwise("none")
    return items.withColumn("phase", phase)


def mirrored(path: Column, source: str = "/sources/", target: str = "/knowledge/") -> Column:
    """The path of a file's counterpart in the other tree."""
    return F.regexp_replace(path, source, target)


def with_counterpart(files: DataFrame, others: DataFrame) -> DataFrame:
    """Files whose counterpart in the other tree exists. Both have a column path."""
    there = others.select(F.col("path").alias("_other")).distinct()
    return files.join(there, mirrored(F.col("path")) == F.col("_other"), "left_semi")


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """What is expected and was not found, each once."""
    return expected.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def unsent_today(reports: DataFrame, sent: DataFrame, day: str, force: bool = False) -> DataFrame:
    """Reports that were not sent on ``day`` yet, or all if forced. sent: report, day."""
    return reports if force else reports.join(sent.where(F.col("day") == day).select("report").distinct(), "report", "left_anti")


def low_confidence(items: DataFrame) -> Column:
    """struct(low, missing): items of low confidence, and apart from them those whose source is gone; null where nothing was measured."""
    gone = F.coalesce(F.col("source_missing"), F.lit(False))
    return F.struct(F.when(F.count("*") > 0, F.count_if((F.col("parse_confidence") == "low") & ~gone)).alias("low"), F.when(F.count("*") > 0, F.count_if(gone)).alias("missing"))


def merged_actions(kept: Column, new: Column) -> Column:
    """A map of actions with new entries put over the kept ones."""
    none = F.expr("CAST(map() AS map<string,string>)")
    old = F.map_filter(F.coalesce(kept, none), lambda k, v: ~F.map_contains_key(F.coalesce(new, none), k))
    return F.map_concat(old, F.coalesce(new, none))


def append_ledger(done: DataFrame, path: str) -> None:
    """Adds the keys of finished items to a ledger of text lines; nothing is written for an empty frame."""
    if not done.isEmpty():
        done.select(F.col("ledger_key").alias("value")).where("trim(value) != ''").write.mode("append").text(path)


def marker_states(events: DataFrame) -> DataFrame:
    """(source, state, at) of events (source, at, kind): the last one holds. An error leaves an error marker, a success clears it, and what is
    too large to be parsed gets a skip marker, which is no failure. Of equal times the success holds, then the skip."""
    rank = F.array_position(F.array(*map(F.lit, ("error", "bulk", "success"))), F.col("kind"))
    last = events.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.struct("at", rank.alias("r"), "kind")).alias("m"))
    state = F.when(F.col("m.kind") == "error", "error").when(F.col("m.kind") == "bulk", "skipped").otherwise("clear")
    return last.select("source", state.alias("state"), F.col("m.at").alias("at"))


def still_due(listed: DataFrame, now: DataFrame) -> DataFrame:
    """Of a list that was made earlier, what is still there and still as long. Both: path, length; checked again right before use."""
    return listed.join(now.select("path", "length").distinct(), ["path", "length"], "left_semi")


def post_checked(outcomes: DataFrame, listing: DataFrame, scan: DataFrame) -> DataFrame:
    """(item, outcome): a failed item counts as done if it has left the inbox or a new scan finds it taken up.

    outcomes: item, failed. listing: item. scan: item, taken_up."""
    there = listing.select("item").distinct().withColumn("_there", F.lit(True))
    taken = scan.where("taken_up").select("item").distinct().withColumn("_taken", F.lit(True))
    j = outcomes.join(there, "item", "left").join(taken, "item", "left")
    return j.select("item", F.when(~F.col("failed"), "done").when(F.col("_there").isNull(), "done, moved").when(F.col("_taken"), "done, taken up").otherwise("failed").alias("outcome"))


def note_state(parsed: Column, verified: Column, asked: Column) -> Column:
    """How far a note's attachment is: none, pending, parsed-pending-verify, or the path of what was parsed."""
    return F.when(verified, parsed).when(parsed.isNotNull(), "parsed-pending-verify").when(F.coalesce(asked, F.lit(False)), "pending").otherwise("none")


def run_outcome(code: Column, size: Column, output: Column, limit: int) -> Column:
    """struct(done, reason): a run is done if it ended with 0 and wrote something. Else the reason is the last line of its output that speaks of
    an error, or its last line, or that there was none; a run ended by the time limit of ``limit`` seconds says so, as it isn't the file's fault."""
    lines = F.filter(F.split(F.coalesce(output, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    telling = F.try_element_at(F.filter(lines, lambda x: x.rlike("(?i)error|exception|not running|denied")), F.lit(-1))
    line = F.coalesce(telling, F.try_element_at(lines, F.lit(-1)), F.concat(F.lit("empty output ("), code.cast("string"), F.lit(")")))
    done = F.coalesce((code == 0) & (size > 0), F.lit(False))
    reason = F.left(F.concat(F.when(code == 124, F.lit(f"timeout {limit}s | ")).otherwise(""), line), F.lit(400))
    return F.struct(done.alias("done"), F.when(~done, reason).alias("reason"))
