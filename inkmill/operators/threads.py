"""Captured mail threads: messages once each, headers, documents, upserts and actions.

Payloads are read with a schema of PARTS levels of MIME parts; the few that may be nested deeper are read one by one in
Python. Defined results: a null
or unreadable time counts as 0; of equal times the first (or, where said, the last) position holds; of repeated
headers the last one; a message listed twice counts once, at its first position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.text import seoul, slug, url_base64

#: Levels of nested parts that are read by a schema.
PARTS = 6
#: The order in which actions run. Fixed values.
ACTIONS = ("task", "schedule", "reply")


def payload_type() -> T.StructType:
    header = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
    body = T.StructType([T.StructField("data", T.StringType())])
    level = T.StructType([T.StructField("mimeType", T.StringType()), T.StructField("body", body)])
    for _ in range(PARTS):
        level = T.StructType([T.StructField("mimeType", T.StringType()), T.StructField("body", body), T.StructField("parts", T.ArrayType(level))])
    return T.StructType([T.StructField("headers", header), *level.fields])


def newest_capture(threads: DataFrame) -> DataFrame:
    """(tid, label, messages): of each thread the capture with the most messages; ties by the later capture, then label."""
    key = F.struct(F.size("messages").alias("k"), "captured_at", F.coalesce("label", F.lit("")).alias("l"))
    best = threads.groupBy("tid").agg(F.max(key).alias("k"))
    j = threads.join(best, "tid").where(key.eqNullSafe(F.col("k")))
    return j.select("tid", "label", "messages").dropDuplicates(["tid"])


def messages(captures: DataFrame) -> DataFrame:
    """(tid, pos, msg_id, sent, snippet, payload): the messages of captures, each once at its first position, pos from 0."""
    each = captures.select("tid", F.posexplode("messages").alias("pos", "m"))
    named = each.select("tid", "pos", F.col("m.id").alias("msg_id"), F.coalesce(F.expr("try_cast(m.internalDate AS bigint)"), F.lit(0)).alias("sent"), F.col("m.snippet").alias("snippet"), F.col("m.payload").alias("payload"))
    first = named.groupBy("tid", "msg_id").agg(F.min("pos").alias("pos"))
    return named.join(first, ["tid", "msg_id", "pos"]).select("tid", "pos", "msg_id", "sent", "snippet", "payload")


def header(payload: Column, name: str) -> Column:
    """A header by its name in any case; the last of equal names; empty if missing."""
    heads = F.coalesce(F.from_json(payload, "headers array<struct<name string, value string>>").headers, F.array().cast("array<struct<name string, value string>>"))
    own = F.filter(heads, lambda h: F.lower(h["name"]) == name)
    return F.coalesce(F.try_element_at(own, F.lit(-1)).value, F.lit(""))


def _deep_bodies(payloads):
    """The bodies of payloads of any depth; null for null."""
    import base64
    import json

    import pandas as pd

    def body(payload: str | None) -> str | None:
        if payload is None:
            return None
        try:
            todo, texts = [json.loads(payload)], {}
        except (ValueError, RecursionError):
            return ""
        while todo:
            part = todo.pop()
            if not isinstance(part, dict):
                continue
            data = (part.get("body") or {}).get("data") if isinstance(part.get("body"), dict) else None
            if isinstance(data, str):
                try:
                    text = base64.urlsafe_b64decode(data.rstrip("=") + "=" * (-len(data.rstrip("=")) % 4)).decode("utf-8", "replace")
                except ValueError:
                    text = ""
                if text.strip(" "):
                    texts.setdefault(part.get("mimeType"), text)
            todo += reversed(part["parts"] if isinstance(part.get("parts"), list) else [])
        return texts.get("text/plain") or texts.get("text/html") or ""

    return pd.Series([body(p) for p in payloads])


def plain_body(payload: Column) -> Column:
    """The first non-empty text/plain part in tree order, else the first text/html part; empty without either."""
    deep = F.pandas_udf(_deep_bodies, "string")(F.when(F.regexp_count(payload, F.lit('"parts"')) > PARTS, payload))

    def parts_of(node: Column, left: int) -> Column:
        own = F.array(F.struct(node.mimeType.alias("kind"), url_base64(node.body.data).alias("text")))
        if not left:
            return own
        return F.concat(own, F.coalesce(F.flatten(F.transform(node.parts, lambda p: parts_of(p, left - 1))), F.array().cast("array<struct<kind string, text string>>")))

    found = parts_of(F.from_json(payload, payload_type()), PARTS)

    def first(kind: str) -> Column:
        return F.try_element_at(F.filter(found, lambda p: (p.kind == kind) & (F.trim(p.text) != "")), F.lit(1)).text

    return F.coalesce(deep, first("text/plain"), first("text/html"), F.lit(""))


def index(captures: DataFrame) -> DataFrame:
    """(tid, n, last_sent, newest, newest_last): the newest message by the first and by the last of equal times."""
    m = messages(captures)
    return m.groupBy("tid").agg(F.count("*").alias("n"), F.max("sent").alias("last_sent"), F.max_by("msg_id", F.struct("sent", -F.col("pos"))).alias("newest"), F.max_by("msg_id", F.struct("sent", "pos")).alias("newest_last"))


def documents(captures: DataFrame) -> DataFrame:
    """(tid, message_count, document): front matter and all messages in order of time, ties by position."""
    m = messages(captures)
    head = {h: header(F.col("payload"), h) for h in ("date", "from", "to", "subject")}
    body = F.trim(F.coalesce(F.nullif(plain_body(F.col("payload")), F.lit("")), F.col("snippet"), F.lit("")))
    block = F.concat(F.lit("### "), head["date"], F.lit("\n**From:** "), head["from"], F.lit("  \n**To:** "), head["to"], F.lit("  \n**Subject:** "), head["subject"], F.lit("\n\n"), body)
    lines = m.select("tid", F.struct("sent", "pos", block.alias("block"), head["subject"].alias("subject"), head["from"].alias("sender")).alias("b"))
    g = lines.groupBy("tid").agg(F.array_sort(F.collect_list("b")).alias("b"))
    top = F.element_at("b", -1)
    last = F.when(top.sent > 0, F.date_format(F.timestamp_millis(top.sent), "yyyy-MM-dd HH:mm")).otherwise("")
    quoted = lambda c: F.regexp_replace(F.to_json(F.struct(c.alias("s"))), r"^\{\"s\":|\}$", "")
    front = F.concat(F.lit("---\ngmail_thread_id: "), F.col("tid"), F.lit("\nmessage_count: "), F.size("b").cast("string"), F.lit('\nlast_internal_date: "'), last, F.lit('"\nsubject: '), quoted(top.subject), F.lit("\nfrom: "), quoted(top.sender), F.lit("\n---\n\n"))
    return g.select("tid", F.size("b").alias("message_count"), F.concat(front, F.array_join(F.col("b.block"), "\n\n---\n\n")).alias("document"))


def folder_name(sent: Column, sender: Column, subject: Column) -> Column:
    """date_sender_subject of a thread's newest message."""
    shown = F.regexp_extract(sender, r"^([^<]*)", 1)
    inside = F.regexp_extract(sender, r"<([^>]+)>", 1)
    who = F.when(sender == "", F.lit("unknown")).otherwise(F.coalesce(F.nullif(F.trim(shown), F.lit("")), F.nullif(inside, F.lit("")), sender))
    return F.concat_ws("_", F.date_format(F.timestamp_millis(sent), "yyyy-MM-dd"), slug(who, 24), slug(subject))


def upserts(found: DataFrame, kept: DataFrame) -> DataFrame:
    """(tid, folder, action): skip a thread that is kept with as many messages, overwrite another count, else new.

    ``found``: tid, n. ``kept``: tid, folder, message_count; of several folders the first by name holds."""
    first = kept.groupBy("tid").agg(F.min(F.struct("folder", "message_count")).alias("k"))
    action = F.when(F.col("k").isNull(), "new").when(F.col("k.message_count").eqNullSafe(F.col("n").cast("int")), "skip").otherwise("overwrite")
    return found.join(first, "tid", "left").select("tid", F.col("k.folder").alias("folder"), action.alias("action"))


def dispatch(labelled: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """(tid, step, action): the actions of a thread's label, always in the order of ACTIONS."""
    table = F.create_map(*(x for k, v in wanted.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))))
    ordered = F.array_intersect(F.array(*map(F.lit, ACTIONS)), F.coalesce(F.element_at(table, F.col("label")), F.array().cast("array<string>")))
    return labelled.select("tid", F.posexplode(ordered).alias("step", "action")).withColumn("step", F.col("step") + 1)


def pending(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """Actions whose id is not yet in the map of done actions of any of the thread's folders."""
    done = kept.select("tid", F.explode(F.map_keys("actions")).alias("action")).distinct()
    return actions.join(done, ["tid", "action"], "left_anti")


def seoul_time(sent: Column) -> Column:
    return seoul(F.timestamp_millis(sent).cast("string"))


def found_threads(items: DataFrame, most: int = 8) -> DataFrame:
    """(label, place, tid): the threads of the first ``most`` found items (label, pos, tid) of each label, each once, in the order first seen."""
    from pyspark.sql import Window

    first = items.withColumn("_k", F.row_number().over(Window.partitionBy("label").orderBy("pos", "tid"))).where(F.col("_k") <= most)
    once = first.where("tid IS NOT NULL").groupBy("label", "tid").agg(F.min("_k").alias("_k"))
    return once.select("label", F.row_number().over(Window.partitionBy("label").orderBy("_k")).alias("place"), "tid")
