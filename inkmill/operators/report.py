"""Reports: statuses, counts, numbering, plain labels and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Statuses, the worst last. Fixed values.
STATUSES = ("ok", "warn", "fail")


def probe(ok: Column, warn_only: bool = False) -> Column:
    """ok or fail (warn) of a check; a check that couldn't be made is none of ok."""
    return F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("warn" if warn_only else "fail")


def summary(items: DataFrame, by: str) -> DataFrame:
    """(by, passed, warned, failed, ok, exit_code) of items with a status."""
    counted = items.groupBy(by).agg(*(F.count_if(F.col("status") == s).alias(n) for s, n in zip(STATUSES, ("passed", "warned", "failed"), strict=True)))
    return counted.withColumn("ok", (F.col("warned") == 0) & (F.col("failed") == 0)).withColumn("exit_code", F.when(F.col("failed") > 0, 1).when(F.col("warned") > 0, 2).otherwise(0))


def numbered(items: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Items with the number g-n: groups counted without gaps, items through all groups. For the items of one report."""
    g = F.dense_rank().over(Window.orderBy(group))
    n = F.row_number().over(Window.orderBy(group, *order))
    return items.withColumn("no", F.concat(g.cast("string"), F.lit("-"), n.cast("string")))


def top_and_rest(rows: DataFrame, group: str, key: str, n: str, most: int = 5) -> DataFrame:
    """(group, place, key, n): the first rows of each group by n, and one row with the number of all others."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(n), key))
    ranked = rows.select(group, key, n, place.alias("place"))
    top = ranked.where(F.col("place") <= most).select(group, "place", key, n)
    rest = ranked.where(F.col("place") > most).groupBy(group).agg(F.count("*").alias("others"), F.sum(n).alias(n))
    return top.unionByName(rest.select(group, F.lit(most + 1).alias("place"), F.concat(F.lit("... "), F.col("others").cast("string"), F.lit(" more")).alias(key), n))


def references(items: DataFrame, by: str, no: str, order: str, most: int = 12) -> DataFrame:
    """(by, total, numbers): the numbers of the first items of each kind, as one text."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(order))
    kept = items.select(by, no, order, place.alias("place"))
    return kept.groupBy(by).agg(F.count("*").alias("total"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= most, F.struct("place", no)))), lambda x: x[no]), ", ").alias("numbers"))


def plain_labels(labels: DataFrame, label: str, exact: dict[str, str], prefixes: list[tuple[str, str]]) -> DataFrame:
    """``labels`` with the column plain: by exact match, else by the first prefix that fits, else as it is."""
    found = F.element_at(F.create_map(*(F.lit(x) for kv in exact.items() for x in kv)), F.col(label))
    by_prefix = [F.when(F.startswith(F.col(label), F.lit(p)), F.concat(F.lit(r), F.substring(F.col(label), len(p) + 1, 10_000))) for p, r in prefixes]
    return labels.withColumn("plain", F.coalesce(found, *by_prefix, F.col(label)))


def expiry_status(days: Column) -> Column:
    """A missing date is a warning, not a failure; nothing left fails; under a week warns."""
    return F.when(days.isNull(), "warn").when(days <= 0, "fail").when(days < 7, "warn").otherwise("ok")


def schedule_status(enabled: Column, status: Column) -> Column:
    return F.when(~enabled, "warn").when(status == "ok", "ok").when(F.coalesce(status, F.lit("unknown")).isin("running", "unknown"), "warn").otherwise("fail")


def stuck(enabled: Column, next_run: Column, now: Column) -> Column:
    """An enabled job whose next run lies over an hour in the past."""
    return F.coalesce(enabled & (next_run < now - F.expr("INTERVAL 1 HOUR")), F.lit(False))


def should_send(ok: Column, mode: str) -> Column:
    """off: never; fail: only when something is missing or not ok; else always."""
    return F.lit(False) if mode == "off" else ~F.coalesce(ok, F.lit(False)) if mode == "fail" else F.lit(True)


def rate_limited(output: Column) -> Column:
    return F.coalesce(output.rlike(r"(?i)rate.?limit|usage limit|too many requests|quota exceeded|\b429\b"), F.lit(False))


def line(no: Column, label: Column, status: Column, detail: Column) -> Column:
    """One line of a report; the detail is shown only where something isn't ok."""
    shown = F.when((status != "ok") & (F.coalesce(detail, F.lit("")) != ""), F.concat(F.lit(" - "), detail)).otherwise("")
    return F.concat(no, F.lit(" "), label, F.lit(" ["), status, F.lit("]"), shown)


def summary_json(items: DataFrame, host: str, now: str) -> DataFrame:
    """(summary): one JSON text of all items (section, label, status, detail) by section; for the items of one report."""
    sections = items.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("label", "status", F.coalesce("detail", F.lit("")).alias("detail")))).alias("items"), *(F.count_if(F.col("status") == s).alias(s) for s in STATUSES))
    one = sections.agg(F.array_sort(F.collect_list(F.struct(F.col("section").alias("key"), "items"))).alias("sections"), *(F.sum(s).alias(s) for s in STATUSES))
    n = {s: F.coalesce(s, F.lit(0)) for s in STATUSES}
    return one.select(F.to_json(F.struct(F.lit(host).alias("host"), F.lit(now).alias("checkedAt"), ((n["warn"] == 0) & (n["fail"] == 0)).alias("ok"), n["ok"].alias("passed"), n["warn"].alias("warned"), n["fail"].alias("failed"), "sections")).alias("summary"))


def headline(total: Column, ok: Column, failed: Column, warned: Column) -> Column:
    """The first line of a report."""
    parts = F.array_join(F.array_compact(F.array(F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" failed"))), F.when(warned > 0, F.concat(warned.cast("string"), F.lit(" warned"))))), ", ")
    share = F.concat(ok.cast("string"), F.lit("/"), total.cast("string"))
    return F.when((failed == 0) & (warned == 0), F.concat(F.lit("all well ("), share, F.lit(")"))).otherwise(F.concat(parts, F.lit(" ("), share, F.lit(" well)")))


def activity(events: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One row with a counter for each kind of activity; kinds: name and the SQL condition that counts."""
    return events.agg(*(F.count_if(F.expr(c)).alias(n) for n, c in kinds.items()))


def counted_or_unknown(n: Column, what: str) -> Column:
    """A line with a count; a count that could not be taken is said to be unknown, not 0."""
    return F.when(n.isNull(), F.lit(f"{what}: unknown")).otherwise(F.concat(F.lit(f"{what}: "), n.cast("string")))


def backlog_status(n: Column, most: int = 20) -> Column:
    return F.when(n > most, "warn").otherwise("ok")


def reset_time(output: Column) -> Column:
    """When a limit is lifted, as a service's output says it; null if it doesn't."""
    return F.nullif(F.lower(F.regexp_extract(output, r"(?i)resets\s+([0-9:]+\s*[ap]m)", 1)), F.lit(""))


def ages(files: DataFrame, by: str, at: str, now: str, most: float) -> DataFrame:
    """(by, files, newest, oldest, oldest_days, status): counts and ages of waiting files; old ones warn."""
    g = files.groupBy(by).agg(F.count(at).alias("files"), F.max(at).alias("newest"), F.min(at).alias("oldest"))
    days = (F.lit(now).cast("timestamp_ntz").cast("timestamp").cast("double") - F.col("oldest").cast("timestamp").cast("double")) / 86400
    return g.withColumn("oldest_days", days).withColumn("status", F.when(F.coalesce(days, F.lit(0.0)) > most, "warn").otherwise("ok"))


def judged(observations: DataFrame, rules: DataFrame) -> DataFrame:
    """(section, label, value, status) of observations (section, label, value) by rules (section, kind, warn, fail).

    kind ``most``: over the bound; ``least``: under it; ``there``: no value. A null bound doesn't apply, a section without a
    rule is ok, and a value that couldn't be taken only warns, but where it must be there."""
    v = F.col("value")
    over = lambda b: F.coalesce(F.when(F.col("kind") == "most", v > F.col(b)).when(F.col("kind") == "least", v < F.col(b)), F.lit(False))
    status = F.when(F.col("kind").isNull(), "ok").when(v.isNull(), F.when(F.col("kind") == "there", "fail").otherwise("warn")).when(over("fail"), "fail").when(over("warn"), "warn").otherwise("ok")
    return observations.join(rules, "section", "left").select("section", "label", "value", status.alias("status"))


def titled(items: DataFrame, titles: DataFrame) -> DataFrame:
    """``items`` (section, ...) with the title of their section: from the table, else the section's own name, else its key."""
    return items.join(titles, "section", "left").withColumn("title", F.coalesce("title", "name", "section")).drop("name")


def composed(items: DataFrame, headline_: str, most: int = 5) -> DataFrame:
    """(report): a report's text of its items (g, title, n, label, status, extra): the headline, the groups with their numbered lines,
    and the numbers of all that is not ok. extra: names listed under a line, the first ``most`` of them and the number of the rest."""
    shown = F.when(F.size("extra") > most, F.concat(F.slice("extra", 1, most), F.array(F.concat(F.lit("... "), (F.size("extra") - most).cast("string"), F.lit(" more"))))).otherwise(F.coalesce("extra", F.array().cast("array<string>")))
    no = F.concat(F.col("g").cast("string"), F.lit("-"), F.col("n").cast("string"))
    own = F.array_join(F.concat(F.array(F.concat(no, F.lit(". "), "label", F.lit(" ["), "status", F.lit("]"))), F.transform(shown, lambda x: F.concat(F.lit("  - "), x))), "\n")
    groups = items.groupBy("g", "title").agg(F.array_sort(F.collect_list(F.struct("n", own.alias("t")))).alias("t"), F.array_sort(F.collect_list(F.when(F.col("status") != "ok", F.struct("n", no.alias("no"))))).alias("bad"), F.count("*").alias("all"), *(F.count_if(F.col("status") == s).alias(s) for s in STATUSES))
    text = F.concat(F.lit("\n"), F.col("g").cast("string"), F.lit(". "), "title", F.lit("\n"), F.array_join(F.col("t.t"), "\n"))
    one = groups.agg(F.array_sort(F.collect_list(F.struct("g", text.alias("x"), F.col("bad.no").alias("no")))).alias("s"), F.sum("all").alias("all"), *(F.sum(s).alias(s) for s in STATUSES))
    refs = F.flatten(F.col("s.no"))
    last = F.when(F.size(refs) > 0, F.concat(F.lit("\n\nsee "), F.array_join(refs, ", "))).otherwise("")
    return one.select(F.concat(F.lit(f"{headline_} "), headline(F.col("all"), F.col("ok"), F.col("fail"), F.col("warn")), F.lit("\n"), F.array_join(F.col("s.x"), "\n"), last).alias("report"))
