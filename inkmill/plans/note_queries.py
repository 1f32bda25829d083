"""Queries of notes, markers, text functions, reports and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import text as fn
from inkmill.operators import gates, notes, report, threads
from inkmill.plans.queries import _CAPTURE, _STATES, _captures, _head_sql, _states, query
from inkmill.plans.session import load, shared_folder
from inkmill.sources import files
from inkmill.streaming import flows

_ISO = "%Y-%m-%d %H:%M"


def _own_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/inkmill/{name}-{uuid.uuid4().hex}"


# ---- markers and work ------------------------------------------------------------------------------------------

_EVENTS = """SELECT source, seen_at AS "at", 1 AS r FROM parse_error WHERE stage IS NOT NULL UNION ALL SELECT pdf_path, parsed_at, 3 FROM mineru UNION ALL
SELECT DISTINCT path, modificationtime, 2 FROM source_file WHERE coalesce(pages, 0) >= 100"""


@query(f"""WITH e AS (SELECT * FROM ({_EVENTS}) WHERE source IS NOT NULL)
SELECT source, CASE m.r WHEN 1 THEN 'error' WHEN 2 THEN 'skipped' ELSE 'clear' END AS state, m."at" AS "at" FROM (SELECT source, max({{'at': e."at", 'r': r}}) AS m FROM e GROUP BY source)""")
def q_marker_states(spark: SparkSession, d: str) -> DataFrame:
    """The marker that each file has now: errors are cleared by a later parse, large files are skipped."""
    e = load(spark, d, "parse_error").where("stage IS NOT NULL").select("source", F.col("seen_at").alias("at"), F.lit("error").alias("kind"))
    good = load(spark, d, "mineru").select("pdf_path", "parsed_at", F.lit("success"))
    big = load(spark, d, "source_file").where("coalesce(pages, 0) >= 100").select("path", "modificationtime", F.lit("bulk")).distinct()
    return gates.marker_states(e.union(good).union(big))


@query(f"WITH {_STATES} SELECT path, state FROM s WHERE state IN ('attempt', 'failed')")
def q_due(spark: SparkSession, d: str) -> DataFrame:
    """What is due when failed files are tried again."""
    return gates.due(_states(spark, d), retry=True)


@query(f"""WITH {_STATES} SELECT path, length FROM (SELECT DISTINCT path, length FROM source_file WHERE path IN (SELECT path FROM s WHERE state = 'attempt')) WHERE (path, length) IN (SELECT path, length FROM source_file WHERE NOT contains(path, '/_hold/') AND length % 7 <> 0)""")
def q_still_due(spark: SparkSession, d: str) -> DataFrame:
    """A list of due files, checked again against what is there when each is taken up."""
    listed = load(spark, d, "source_file").join(gates.due(_states(spark, d)), "path", "left_semi").select("path", "length").distinct()
    now = load(spark, d, "source_file").where(~F.contains("path", F.lit("/_hold/")) & (F.col("length") % 7 != 0))
    return gates.still_due(listed, now)


@query("""WITH o AS (SELECT DISTINCT source AS item FROM parse_error WHERE source IS NOT NULL), a AS (SELECT item, bool_or(reason IS NOT NULL) AS failed FROM o JOIN parse_error ON source = item GROUP BY item)
SELECT item, CASE WHEN NOT failed THEN 'done' WHEN item NOT IN (SELECT path FROM source_file WHERE length % 3 <> 0) THEN 'done, moved' WHEN item IN (SELECT pdf_path FROM mineru WHERE pdf_path IS NOT NULL) THEN 'done, taken up' ELSE 'failed' END AS outcome FROM a""")
def q_post_checked(spark: SparkSession, d: str) -> DataFrame:
    """Failed items that turn out to be done: gone from the listing, or taken up by a new scan."""
    o = load(spark, d, "parse_error").where("source IS NOT NULL").groupBy(F.col("source").alias("item")).agg(F.max(F.col("reason").isNotNull()).alias("failed"))
    listing = load(spark, d, "source_file").where("length % 3 <> 0").select(F.col("path").alias("item"))
    scan = load(spark, d, "mineru").where("pdf_path IS NOT NULL").select(F.col("pdf_path").alias("item"), F.lit(True).alias("taken_up"))
    return gates.post_checked(o, listing, scan)


@query("""WITH f AS (SELECT path, bool_or(pages IS NOT NULL) AS asked FROM source_file GROUP BY path), p AS (SELECT pdf_path AS path, bool_or(markdown IS NOT NULL) AS parsed FROM docling GROUP BY pdf_path), v AS (SELECT DISTINCT pdf_path AS path FROM mineru)
SELECT f.path, CASE WHEN v.path IS NOT NULL THEN f.path || '_parse' WHEN parsed THEN 'parsed-pending-verify' WHEN asked THEN 'pending' ELSE 'none' END AS state FROM f LEFT JOIN p ON p.path = f.path LEFT JOIN v ON v.path = f.path""")
def q_note_states(spark: SparkSession, d: str) -> DataFrame:
    """How far each file's parse is."""
    f = load(spark, d, "source_file").groupBy("path").agg(F.max(F.col("pages").isNotNull()).alias("asked"))
    p = load(spark, d, "docling").groupBy(F.col("pdf_path").alias("path")).agg(F.max(F.col("markdown").isNotNull()).alias("parsed"))
    v = load(spark, d, "mineru").select(F.col("pdf_path").alias("path")).distinct().withColumn("verified", F.lit(True))
    j = f.join(p, "path", "left").join(v, "path", "left")
    place = F.when(F.col("parsed") | F.col("verified"), fn.parse_dir(F.col("path")))
    return j.select("path", gates.note_state(place, F.coalesce("verified", F.lit(False)), F.col("asked")).alias("state"))


@query("""SELECT label, row_number() OVER (PARTITION BY label ORDER BY k)::INT AS place, tid FROM (SELECT label, tid, min(k) AS k FROM (SELECT coalesce(label, '?') AS label, tid, row_number() OVER (PARTITION BY coalesce(label, '?') ORDER BY epoch_us(captured_at), tid) AS k FROM thread) WHERE k <= 8 AND tid IS NOT NULL GROUP BY ALL)""")
def q_found_threads(spark: SparkSession, d: str) -> DataFrame:
    """The first eight captures found of each label, as threads in the order first seen."""
    t = load(spark, d, "thread").select(F.coalesce("label", F.lit("?")).alias("label"), F.col("captured_at").alias("pos"), "tid")
    return threads.found_threads(t)


@query("SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16') GROUP BY user_id")
def q_unsent_today(spark: SparkSession, d: str) -> DataFrame:
    """Users whose report was not sent on a day."""
    e = load(spark, d, "events")
    sent = e.select(F.col("user_id").alias("report"), F.to_date("ts").cast("string").alias("day"))
    return gates.unsent_today(e.groupBy(F.col("user_id").alias("report")).agg(F.count("*").alias("n")), sent, "2024-01-15").select(F.col("report").alias("user_id"), "n")


@query("""SELECT coalesce(via, '?') AS via, count(*) FILTER (low AND NOT gone) AS low, count(*) FILTER (gone) AS missing FROM (SELECT via, coalesce(pages, 0) = 0 AS low, markdown IS NULL AS gone FROM docling) GROUP BY ALL""")
def q_low_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Records of low confidence, and apart from them those that have nothing to parse."""
    r = load(spark, d, "docling").select(F.coalesce("via", F.lit("?")).alias("via"), F.when(F.coalesce("pages", F.lit(0)) == 0, "low").otherwise("ok").alias("parse_confidence"), F.col("markdown").isNull().alias("source_missing"))
    return r.groupBy("via").agg(gates.low_confidence(r).alias("c")).select("via", "c.low", "c.missing")


@query("SELECT DISTINCT trim(ledger_key) AS ledger_key FROM ledger WHERE trim(ledger_key) <> ''")
def q_ledger_append(spark: SparkSession, d: str) -> DataFrame:
    """A ledger of text lines, appended in two runs and read again; blank keys are never written."""
    at = _own_folder(spark, "ledger")
    keys = load(spark, d, "ledger").where("ledger_key IS NOT NULL")
    for odd in (0, 1):
        gates.append_ledger(keys.where(F.pmod(F.xxhash64("ledger_key"), F.lit(2)) == odd), at)
    return spark.read.text(at).select(F.trim("value").alias("ledger_key")).distinct()


@query("""SELECT DISTINCT left(l_shipdate::VARCHAR, 10) AS day, CASE WHEN l_linenumber % 2 = 0 THEN left(l_shipdate::VARCHAR, 10) || 'x' ELSE (l_shipdate::DATE + 1)::VARCHAR END AS ends, l_linenumber % 2 AS k FROM lineitem""")
def q_all_day(spark: SparkSession, d: str) -> DataFrame:
    """The exclusive ends of all-day events; what is no date stays as it is."""
    x = load(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), (F.col("l_linenumber") % 2).alias("k")).distinct()
    return x.select("day", fn.all_day_end(F.when(F.col("k") == 0, F.concat("day", F.lit("x"))).otherwise(F.col("day"))).alias("ends"), "k")


@query("""WITH r AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 124 WHEN 2 THEN 1 ELSE 0 END AS rc, CASE WHEN event_id % 8 = 3 THEN 0 ELSE event_id % 50 + 1 END AS size,
CASE event_id % 3 WHEN 0 THEN 'start' || chr(10) || 'An ERROR in ' || event_type || chr(10) || 'end' WHEN 1 THEN 'start' || chr(10) || 'end of ' || event_type ELSE '' END AS e FROM events)
SELECT event_id, rc = 0 AND size > 0 AS done, CASE WHEN NOT (rc = 0 AND size > 0) THEN left(CASE WHEN rc = 124 THEN 'timeout 900s | ' ELSE '' END || CASE event_id % 3 WHEN 0 THEN string_split(e, chr(10))[2] WHEN 1 THEN string_split(e, chr(10))[2] ELSE 'empty output (' || rc || ')' END, 400) END AS reason FROM r""")
def q_run_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What a run came to: done only with code 0 and some output, else its last telling line, with timeouts named."""
    k = F.col("event_id")
    code = F.when(k % 4 == 1, 124).when(k % 4 == 2, 1).otherwise(0)
    size = F.when(k % 8 == 3, 0).otherwise(k % 50 + 1)
    said = F.when(k % 3 == 0, F.concat(F.lit("start\nAn ERROR in "), "event_type", F.lit("\nend\n"))).when(k % 3 == 1, F.concat(F.lit("start\nend of "), "event_type")).otherwise("")
    o = gates.run_outcome(code, size, said, 900)
    return load(spark, d, "events").select("event_id", o.done.alias("done"), o.reason.alias("reason"))


# ---- notes -----------------------------------------------------------------------------------------------------

_CODE = "chr((97 + o_orderkey % 26)::INT) || 'bc-defg-' || chr((97 + o_orderkey % 11)::INT) || 'ij'"


def _code() -> Column:
    k = F.col("o_orderkey")
    return F.concat(F.char(97 + k % 26), F.lit("bc-defg-"), F.char(97 + k % 11), F.lit("ij"))


@query(rf"""WITH n AS (SELECT {_CODE} AS code, CASE WHEN o_orderkey % 5 = 0 THEN '.hidden/' ELSE 'k/' END || 'note' || o_orderkey || '.md' AS path, o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0)
SELECT code, arg_max('note' || k, path) AS note FROM n WHERE path LIKE 'k/%' GROUP BY code""")
def q_meetings(spark: SparkSession, d: str) -> DataFrame:
    """Meeting codes of notes: behind a slash, within the head, not in hidden folders; the last note by path holds."""
    k = F.col("o_orderkey")
    head = F.when(k % 3 == 0, F.repeat(F.lit("x"), F.lit(notes.HEAD_CHARS))).otherwise("---")
    link = F.concat(F.lit("\nmeet_link: https://m.example"), F.when(k % 4 == 0, "=").otherwise("/"), _code(), F.lit("\n"))
    n = load(spark, d, "orders").select(F.concat(F.when(k % 5 == 0, ".hidden/").otherwise("k/"), F.lit("note"), k.cast("string"), F.lit(".md")).alias("path"), F.concat(head, link).alias("text"))
    return notes.meetings(n)


@query(rf"""WITH n AS (SELECT {_CODE} AS code, min('note' || o_orderkey) AS note FROM orders WHERE o_orderkey % 5 = 0 GROUP BY ALL), o AS (SELECT o_orderkey, {_CODE} AS code, left(o_orderdate::VARCHAR, 10) AS day FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN day || '_' || coalesce(note, code) || '_rec.mov' WHEN 1 THEN day || '_' || coalesce(note, code) || '_rec.mp4' ELSE code || '_of_a_talk.mov' END AS target FROM o LEFT JOIN n USING (code)""")
def q_recordings(spark: SparkSession, d: str) -> DataFrame:
    """Names of recordings: date, note (or code) and a fixed suffix; a name without a date keeps its words."""
    k = F.col("o_orderkey")
    o = load(spark, d, "orders").withColumn("c", _code())
    index = o.where(k % 5 == 0).groupBy(F.col("c").alias("code")).agg(F.min(F.concat(F.lit("note"), k.cast("string"))).alias("note"))
    dated = F.concat("c", F.lit(" ("), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10 00)"))
    names = o.select("o_orderkey", F.when(k % 3 == 0, F.concat(dated, F.lit(".mov"))).when(k % 3 == 1, dated).otherwise(F.concat("c", F.lit(" of a talk.mov"))).alias("name"))
    return notes.named_recordings(names, index, "rec").select("o_orderkey", "target")


@query("""WITH l AS (SELECT p_partkey // 20 AS doc, p_partkey, p_name AS key, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END AS hint FROM part) SELECT doc, key, arg_max(hint, p_partkey) AS hint FROM l WHERE hint <> '' GROUP BY ALL""")
def q_guide(spark: SparkSession, d: str) -> DataFrame:
    """Keys and hints of guides in markdown tables."""
    line = F.concat(F.lit("| `{{"), "p_name", F.lit("}}` | x | "), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_type")), F.lit(" |"))
    p = load(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 20).alias("doc")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))).alias("l"))
    return notes.guide(p.select("doc", F.concat(F.lit("| key | - | hint |\n|---|---|---|\n"), F.array_join(F.col("l.line"), "\n")).alias("md")), "doc", "md")


_LINE = "coalesce(source, '') || CASE WHEN length(coalesce(reason, '')) % 9 = 0 THEN '' ELSE chr(9) || CASE WHEN length(reason) % 4 = 0 THEN 'x' ELSE length(reason)::VARCHAR END || chr(9) || coalesce(ts, '') || chr(9) || coalesce(reason, '') END"


@query(f"""WITH p AS (SELECT DISTINCT string_split({_LINE}, chr(9)) AS p FROM parse_error) SELECT p[1] AS item, try_cast(p[2] AS INT) AS fails, p[3] AS "at", p[4] AS reason FROM p WHERE len(p) >= 2""")
def q_fail_lines(spark: SparkSession, d: str) -> DataFrame:
    """A ledger of failures in tab-separated lines: short lines are none, a count that is no number is null."""
    n = F.length("reason")
    rest = F.concat(F.lit("\t"), F.when(n % 4 == 0, "x").otherwise(n.cast("string")), F.lit("\t"), F.coalesce("ts", F.lit("")), F.lit("\t"), F.coalesce("reason", F.lit("")))
    line = F.concat(F.coalesce("source", F.lit("")), F.when(F.length(F.coalesce("reason", F.lit(""))) % 9 == 0, "").otherwise(rest))
    return notes.counted_failures(load(spark, d, "parse_error").select(line.alias("value")).distinct())


@query("SELECT doc_id, regexp_replace(text, '<colgroup>', '', 'g') AS t FROM documents WHERE false UNION ALL SELECT p_partkey, '<p>' || p_name || '</p>' FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_name || chr(10) || p_type FROM part WHERE p_partkey % 2 = 1".replace("doc_id,", "doc_id AS p_partkey,"))
def q_converted(spark: SparkSession, d: str) -> DataFrame:
    """Converted documents without column groups, and without a table of one cell around all of it."""
    one = F.concat(F.lit("<table>\n<tbody>\n<tr>\n<td><p>"), "p_name", F.lit("</p></td>\n</tr>\n</tbody>\n</table>\n"))
    two = F.concat("p_name", F.lit("\n<colgroup>\n<col/>\n</colgroup>\n"), "p_type")
    return load(spark, d, "part").select("p_partkey", notes.clean_converted(F.when(F.col("p_partkey") % 2 == 0, one).otherwise(two)).alias("t"))


@query("""SELECT '---' || chr(10) || 'source: ' || p_name || chr(10) || CASE WHEN p_size % 2 = 0 THEN 'refine_confidence: low' || chr(10) ELSE '' END || '---' || chr(10) || chr(10) || '# ' || p_brand || chr(10) || chr(10) || p_type AS value FROM part""")
def q_refined(spark: SparkSession, d: str) -> DataFrame:
    """Refined notes: front matter and body; low confidence only where there was a warning."""
    low = F.when(F.col("p_size") % 2 == 0, "low")
    return files.refined(load(spark, d, "part"), "p_brand", {"source": F.col("p_name"), "refine_confidence": low}, "p_type")


# ---- text ------------------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, md5(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{feff}]', '', 'g')) AS clean, 'Re: ' || left(text, 120) AS subject, left(text, 2048) AS head,
CASE WHEN contains(source, '_') THEN 'label:"' || source || '"' ELSE NULL END AS q, NOT coalesce(regexp_matches(text, '^\s*STATUS:\s*ok\b'), false) AS review FROM documents WHERE text IS NOT NULL AND NOT lower(text) LIKE 're:%'""")
def q_texts(spark: SparkSession, d: str) -> DataFrame:
    """Controls dropped, subjects answered, heads cut by code points, label searches and the review mark."""
    t = F.col("text")
    docs = load(spark, d, "documents").where(t.isNotNull() & ~F.lower(t).startswith("re:"))
    return docs.select("doc_id", F.md5(fn.clean_controls(t)).alias("clean"), fn.reply_subject(F.left(t, F.lit(120))).alias("subject"), F.left(t, F.lit(2048)).alias("head"), F.when(F.contains("source", F.lit("_")), fn.label_query(F.col("source"))).alias("q"), fn.needs_review(t).alias("review"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_partkey % 26 + 26 * (p_partkey % 5) END::INT AS col, CASE WHEN p_partkey % 3 = 0 THEN 'label:' || replace(p_name, ' ', '-') || '+x' ELSE 'label:"' || p_name || '"' END AS q, p_size % 2 = 1 AS review FROM part""")
def q_part_codes(spark: SparkSession, d: str) -> DataFrame:
    """Columns of spreadsheet references, label searches, and replies whose first line says how they stand."""
    k = F.col("p_partkey")
    big = F.when(k % 5 > 0, F.char(64 + k % 5)).otherwise("")
    ref = F.when(k % 4 == 0, "12").otherwise(F.concat(big, F.char(65 + k % 26), F.lit("12")))
    label = F.when(k % 3 == 0, F.concat("p_name", F.lit("+x"))).otherwise(F.col("p_name"))
    reply = F.concat(F.lit("STATUS: "), F.when(F.col("p_size") % 2 == 0, "ok").otherwise("review"), F.lit("\nSTATUS: ok"))
    return load(spark, d, "part").select("p_partkey", fn.column_index(ref).alias("col"), fn.label_query(label).alias("q"), fn.needs_review(reply).alias("review"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE text END AS back FROM documents WHERE text IS NOT NULL""")
def q_url_base64(spark: SparkSession, d: str) -> DataFrame:
    """URL-safe base64, with and without padding, back to text; what is none is null."""
    code = F.translate(F.base64(F.encode("text", "UTF-8")), "+/\r\n", "-_")
    given = F.when(F.col("doc_id") % 3 == 0, "*").when(F.col("doc_id") % 3 == 1, code).otherwise(F.regexp_replace(code, "=+$", ""))
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", fn.url_base64(given).alias("back"))


_NEWEST = _CAPTURE + ", top AS (SELECT tid, arg_max(payload, (sent, pos)) AS payload, max(sent) AS sent, count(*) AS n FROM msg GROUP BY tid)"


@query(_NEWEST + f""" SELECT tid, n, '---' || chr(10) || 'gmail_thread_id: ' || tid || chr(10) || 'message_count: ' || n || chr(10) || 'last_internal_date: "' || CASE WHEN sent > 0 THEN strftime(make_timestamp(sent * 1000), '{_ISO}') ELSE '' END || '"' || chr(10) || 'subject: ' || to_json({_head_sql('subject')}) || chr(10) || 'from: ' || to_json({_head_sql('from')}) || chr(10) || '---' AS front FROM top""")
def q_thread_front(spark: SparkSession, d: str) -> DataFrame:
    """The front matter of each thread's document."""
    docs = threads.documents(_captures(spark, d))
    return docs.select("tid", F.col("message_count").cast("bigint").alias("n"), F.regexp_extract("document", r"(?s)^(---\n.*?\n---)\n\n", 1).alias("front"))


_MIME = _CAPTURE.replace("WITH cap", "WITH RECURSIVE cap") + """, node AS (SELECT msg_id, payload::JSON AS part, []::BIGINT[] AS path FROM msg WHERE json_valid(payload) UNION ALL
SELECT msg_id, unnest(CASE WHEN json_type(part->'$.parts') = 'ARRAY' THEN CAST(part->'$.parts' AS JSON[]) ELSE [] END), list_append(path, unnest(range(len(CASE WHEN json_type(part->'$.parts') = 'ARRAY' THEN CAST(part->'$.parts' AS JSON[]) ELSE [] END)))) FROM node),
raw AS (SELECT msg_id, path, part->>'$.mimeType' AS kind, rtrim(part->>'$.body.data', '=') AS d FROM node),
bytes AS (SELECT *, TRY(from_base64(translate(d, '-_', '+/') || repeat('=', (4 - length(d) % 4) % 4))) AS b FROM raw WHERE d IS NOT NULL),
said AS (SELECT *, TRY(decode(b)) AS t FROM bytes WHERE b IS NOT NULL),
best AS (SELECT msg_id, arg_min({'t': t}, (CASE kind WHEN 'text/plain' THEN 0 ELSE 1 END, path)) AS best FROM said WHERE kind IN ('text/plain', 'text/html') AND (t IS NULL OR trim(t, ' ') <> '') GROUP BY msg_id)"""


@query(_MIME + """ SELECT msg.msg_id, CASE WHEN best IS NULL THEN md5('') ELSE md5(best.t) END AS body FROM msg LEFT JOIN best ON best.msg_id = msg.msg_id""")
def q_plain_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The plain body of every message, however its parts are nested; null where it has bytes that are not UTF-8."""
    body = threads.plain_body(F.col("payload"))
    return threads.messages(_captures(spark, d)).select("msg_id", F.when(~F.contains(body, F.lit("\ufffd")), F.md5(body)).alias("body"))


_DOCS = _MIME.replace("arg_min(m.payload, pos) AS payload", "arg_min(m.payload, pos) AS payload, arg_min({'s': m.snippet}, pos) AS snip") + f""", told AS (SELECT msg.tid, sent, pos, coalesce(best.t IS NULL AND best IS NOT NULL, false) AS bad, {_head_sql('subject')} AS subject, {_head_sql('from')} AS sender,
'### ' || {_head_sql('date')} || chr(10) || '**From:** ' || {_head_sql('from')} || '  ' || chr(10) || '**To:** ' || {_head_sql('to')} || '  ' || chr(10) || '**Subject:** ' || {_head_sql('subject')} || chr(10) || chr(10) || trim(coalesce(nullif(best.t, ''), snip.s, ''), ' ') AS block
FROM msg LEFT JOIN best ON best.msg_id = msg.msg_id),
docs AS (SELECT tid, bool_or(bad) AS bad, max(sent) AS sent, count(*) AS n, arg_max({{'s': subject, 'f': sender}}, (sent, pos)) AS top, string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY sent, pos) AS blocks FROM told GROUP BY tid)"""


@query(_DOCS + f""" SELECT tid, CASE WHEN NOT bad THEN md5('---' || chr(10) || 'gmail_thread_id: ' || tid || chr(10) || 'message_count: ' || n || chr(10) || 'last_internal_date: "' || CASE WHEN sent > 0 THEN strftime(make_timestamp(sent * 1000), '{_ISO}') ELSE '' END || '"' || chr(10) || 'subject: ' || to_json(top.s) || chr(10) || 'from: ' || to_json(top.f) || chr(10) || '---' || chr(10) || chr(10) || blocks) END AS document FROM docs""")
def q_thread_documents(spark: SparkSession, d: str) -> DataFrame:
    """The whole document of every thread, as a hash; null where a body has bytes that are not UTF-8."""
    return threads.documents(_captures(spark, d)).select("tid", F.when(~F.contains("document", F.lit("\ufffd")), F.md5("document")).alias("document"))


_NAMED = r"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '^[\s\x0b]+|[\s\x0b]+$', '', 'g'), '[\s\x0b]+', '-', 'g'), '[\\/:*?\"<>|]', '', 'g'), '^[-. ]+|[-. ]+$', '', 'g')[1:{1}], ''), 'no-subject')"


@query(_CAPTURE + f""", h AS (SELECT msg_id, sent, {_head_sql('from')} AS f, {_head_sql('subject')} AS s FROM msg),
w AS (SELECT *, CASE WHEN f = '' THEN 'unknown' ELSE coalesce(nullif(trim(regexp_extract(f, '^([^<]*)', 1), ' '), ''), nullif(regexp_extract(f, '<([^>]+)>', 1), ''), f) END AS who FROM h)
SELECT msg_id, strftime(make_timestamp(sent * 1000), '%Y-%m-%d') || '_' || {_NAMED.format('who', 24)} || '_' || {_NAMED.format('s', 50)} AS folder FROM w""")
def q_folder_names(spark: SparkSession, d: str) -> DataFrame:
    """date_sender_subject of every message."""
    p = F.col("payload")
    return threads.messages(_captures(spark, d)).select("msg_id", threads.folder_name(F.col("sent"), threads.header(p, "from"), threads.header(p, "subject")).alias("folder"))


# ---- reports ---------------------------------------------------------------------------------------------------


@query("""SELECT source, reason, lower(nullif(regexp_extract(reason, '(?i)resets\\s+([0-9:]+\\s*[ap]m)', 1), '')) AS lifted FROM (SELECT source, coalesce(reason, '') || CASE WHEN length(source) % 3 = 0 THEN ' - usage limit, Resets 3:' || lpad((length(source) % 60)::VARCHAR, 2, '0') || ' PM' ELSE '' END AS reason FROM parse_error GROUP BY ALL)""")
def q_reset_times(spark: SparkSession, d: str) -> DataFrame:
    """When a limit is lifted, by the failure's output."""
    n = F.length("source")
    said = F.concat(F.coalesce("reason", F.lit("")), F.coalesce(F.when(n % 3 == 0, F.concat(F.lit(" - usage limit, Resets 3:"), F.lpad((n % 60).cast("string"), 2, "0"), F.lit(" PM"))), F.lit("")))
    return load(spark, d, "parse_error").select("source", said.alias("reason")).distinct().withColumn("lifted", report.reset_time(F.col("reason")))


@query("""SELECT folder, count(modificationtime) AS files, max(modificationtime) AS newest, min(modificationtime) AS oldest, epoch(TIMESTAMP '2026-11-01' - min(modificationtime)) / 86400 AS oldest_days, CASE WHEN coalesce(epoch(TIMESTAMP '2026-11-01' - min(modificationtime)) / 86400, 0) > 7 THEN 'warn' ELSE 'ok' END AS status
FROM (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, modificationtime FROM source_file) GROUP BY folder""")
def q_waiting(spark: SparkSession, d: str) -> DataFrame:
    """How many files wait in each folder, and since when."""
    f = load(spark, d, "source_file").select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), "modificationtime")
    return report.ages(f, "folder", "modificationtime", "2026-11-01 00:00:00", 7)


_OBSERVED = """o AS (SELECT 'gateway' AS section, coalesce(host, '?') AS label, count(*)::DOUBLE AS value FROM parse_error GROUP BY ALL UNION ALL SELECT 'auth', c_mktsegment, min(c_acctbal) FROM customer GROUP BY ALL UNION ALL
SELECT 'cron', event_type, max(value) FROM events GROUP BY ALL UNION ALL SELECT 'wiring', coalesce(via, '?'), sum(pages)::DOUBLE FROM docling GROUP BY ALL UNION ALL SELECT 'hostauto', coalesce(label, '?'), count(*)::DOUBLE FROM thread GROUP BY ALL UNION ALL
SELECT 'data', folder, sum(message_count)::DOUBLE FROM capture_state GROUP BY ALL UNION ALL SELECT 'sync', coalesce(lang, '?'), count(text)::DOUBLE FROM documents GROUP BY ALL),
r AS (SELECT * FROM (VALUES ('gateway', 'most', 300.0, 600.0), ('auth', 'least', 0.0, -990.0), ('cron', 'most', 90.0, NULL), ('wiring', 'there', NULL, NULL), ('hostauto', 'least', 50.0, 20.0), ('data', 'there', NULL, NULL)) t(section, kind, warn, fail))"""


def _observations(spark: SparkSession, d: str) -> DataFrame:
    """Observations of seven groups of checks, each from one table."""

    def of(section: str, table: str, label: str, value: Column) -> DataFrame:
        return load(spark, d, table).groupBy(F.coalesce(label, F.lit("?")).alias("label")).agg(value.cast("double").alias("value")).select(F.lit(section).alias("section"), "label", "value")

    parts = [of("gateway", "parse_error", "host", F.count("*")), of("auth", "customer", "c_mktsegment", F.min("c_acctbal")), of("cron", "events", "event_type", F.max("value")), of("wiring", "docling", "via", F.sum("pages")), of("hostauto", "thread", "label", F.count("*")), of("data", "capture_state", "folder", F.sum("message_count")), of("sync", "documents", "lang", F.count("text"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("gateway", "most", 300.0, 600.0), ("auth", "least", 0.0, -990.0), ("cron", "most", 90.0, None), ("wiring", "there", None, None), ("hostauto", "least", 50.0, 20.0), ("data", "there", None, None)], "section string, kind string, warn double, fail double")


_JUDGED = _OBSERVED + """, j AS (SELECT o.section, label, value, CASE WHEN kind IS NULL THEN 'ok' WHEN value IS NULL THEN CASE WHEN kind = 'there' THEN 'fail' ELSE 'warn' END WHEN kind = 'most' AND value > fail OR kind = 'least' AND value < fail THEN 'fail' WHEN kind = 'most' AND value > warn OR kind = 'least' AND value < warn THEN 'warn' ELSE 'ok' END AS status FROM o LEFT JOIN r ON r.section = o.section)"""


@query(f"WITH {_JUDGED} SELECT section, label, value, status FROM j")
def q_checks(spark: SparkSession, d: str) -> DataFrame:
    """Seven groups of checks: observations judged by the rules of their group."""
    return report.judged(_observations(spark, d), F.broadcast(_rules(spark)))


@query(f"""WITH {_JUDGED}, t AS (SELECT * FROM (VALUES ('gateway', 'The gateway'), ('auth', 'Rights')) t(section, title)) SELECT j.section, coalesce(title, CASE WHEN j.section = 'sync' THEN NULL ELSE upper(j.section) END, j.section) AS title, count(*) AS items FROM j LEFT JOIN t ON t.section = j.section GROUP BY ALL""")
def q_titles(spark: SparkSession, d: str) -> DataFrame:
    """The titles of sections: from a table, else the section's own name, else its key."""
    titles = F.broadcast(spark.createDataFrame([("gateway", "The gateway"), ("auth", "Rights")], "section string, title string"))
    items = _observations(spark, d).withColumn("name", F.when(F.col("section") != "sync", F.upper("section")))
    return report.titled(items, titles).groupBy("section", "title").agg(F.count("*").alias("items"))


@query("""SELECT user_id, CASE WHEN ok IS NOT NULL AND ok THEN 'ok' ELSE 'fail' END AS strict, CASE WHEN ok IS NOT NULL AND ok THEN 'ok' ELSE 'warn' END AS lax, false AS sent_off, NOT coalesce(ok, false) AS sent_fail, true AS sent_all, CASE WHEN n IS NULL THEN 'errors: unknown' ELSE 'errors: ' || n END AS line
FROM (SELECT user_id, bool_and(value < 95) AS ok, CASE WHEN user_id % 9 <> 0 THEN count(*) FILTER (event_type = 'error') END AS n FROM events GROUP BY user_id)""")
def q_policies(spark: SparkSession, d: str) -> DataFrame:
    """Checks that may not be made, when a report is sent, and counts that may be unknown."""
    u = load(spark, d, "events").groupBy("user_id").agg(F.min(F.col("value") < 95).alias("ok"), F.count_if(F.col("event_type") == "error").alias("n"))
    ok, n = F.col("ok"), F.when(F.col("user_id") % 9 != 0, F.col("n"))
    return u.select("user_id", report.probe(ok).alias("strict"), report.probe(ok, warn_only=True).alias("lax"), report.should_send(ok, "off").alias("sent_off"), report.should_send(ok, "fail").alias("sent_fail"), report.should_send(ok, "all").alias("sent_all"), report.counted_or_unknown(n, "errors").alias("line"))


@query(f"""WITH {_JUDGED}, n AS (SELECT *, dense_rank() OVER (ORDER BY section) AS g, row_number() OVER (ORDER BY section, label) AS n FROM j), e AS (SELECT coalesce(host, '?') AS label, list(source ORDER BY source) AS x FROM (SELECT DISTINCT host, source FROM parse_error WHERE source IS NOT NULL) GROUP BY ALL),
l AS (SELECT n.*, g || '-' || n AS no, g || '-' || n || '. ' || n.label || ' [' || status || ']' AS t, CASE WHEN section = 'gateway' THEN x END AS x FROM n LEFT JOIN e ON e.label = n.label),
k AS (SELECT *, g || '-' || n || '. ' || label || ' [' || status || ']' || coalesce(array_to_string(list_transform(list_concat(x[1:5], CASE WHEN len(x) > 5 THEN ['... ' || (len(x) - 5) || ' more'] ELSE [] END), lambda v: chr(10) || '  - ' || v), ''), '') AS own FROM l),
s AS (SELECT g, section, chr(10) || g || '. ' || section || chr(10) || string_agg(own, chr(10) ORDER BY n) AS t FROM k GROUP BY g, section),
c AS (SELECT count(*) AS a, count(*) FILTER (status = 'ok') AS o, count(*) FILTER (status = 'fail') AS f, count(*) FILTER (status = 'warn') AS w, string_agg(no, ', ' ORDER BY n) FILTER (status <> 'ok') AS refs FROM k)
SELECT 'state: ' || CASE WHEN f = 0 AND w = 0 THEN 'all well (' || o || '/' || a || ')' ELSE array_to_string(list_filter([CASE WHEN f > 0 THEN f || ' failed' END, CASE WHEN w > 0 THEN w || ' warned' END], lambda z: z IS NOT NULL), ', ') || ' (' || o || '/' || a || ' well)' END || chr(10) || (SELECT string_agg(t, chr(10) ORDER BY g) FROM s) || coalesce(chr(10) || chr(10) || 'see ' || refs, '') AS report FROM c""")
def q_report(spark: SparkSession, d: str) -> DataFrame:
    """A whole report of the checks: headline, groups, numbered lines with what they list, and the numbers of all problems."""
    items = report.numbered(report.judged(_observations(spark, d), F.broadcast(_rules(spark))), "section", ["label"])
    failed = load(spark, d, "parse_error").where("source IS NOT NULL").groupBy(F.coalesce("host", F.lit("?")).alias("label")).agg(F.array_sort(F.collect_set("source")).alias("extra"))
    no = F.split("no", "-")
    j = items.join(failed, "label", "left").select(no[0].cast("int").alias("g"), F.col("section").alias("title"), no[1].cast("int").alias("n"), "label", "status", F.when(F.col("section") == "gateway", F.col("extra")).alias("extra"))
    return report.composed(j, "state:")


# ---- streams ---------------------------------------------------------------------------------------------------


@query("""SELECT event_id::VARCHAR AS id, 'about ' || event_type AS question, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'u' || user_id END AS reply_target FROM events WHERE event_id % 4 <> 0""")
def q_stream_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of a folder of JSON files, drained once; those without a question are none."""
    at = _own_folder(spark, "jobs")
    k = F.col("event_id")
    e = load(spark, d, "events").select(k.cast("string").alias("id"), F.when(k % 8 == 0, "  ").when(k % 4 != 0, F.concat(F.lit("about "), "event_type")).alias("question"), F.lit("chat").alias("reply_channel"), F.when(k % 3 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("reply_target"))
    e.write.json(f"{at}/in")
    flows.drained(flows.jobs(spark, f"{at}/in"), f"{at}/state", lambda b, n: b.write.mode("append").parquet(f"{at}/out"))
    return spark.read.parquet(f"{at}/out").select("id", "question", "reply_target")


@query("""WITH c AS (SELECT user_id, max(event_id) FILTER (event_type <> 'error') AS cleared, arg_max(event_type, event_id) AS last FROM events GROUP BY user_id), f AS (SELECT e.user_id, count(*) FILTER (event_type = 'error' AND (cleared IS NULL OR event_id > cleared)) AS fails FROM events e JOIN c USING (user_id) GROUP BY ALL)
SELECT user_id::VARCHAR AS item, CASE WHEN last = 'error' THEN 'failed' ELSE 'done' END AS outcome, fails::INT AS fails, fails >= 2 AS given_up FROM f JOIN c USING (user_id)""")
def q_stream_retries(spark: SparkSession, d: str) -> DataFrame:
    """Failures since the last success of each item, kept as the state of a stream."""
    at = _own_folder(spark, "retries")
    table = load(spark, d, "events").select(F.col("user_id").cast("string").alias("item"), F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("outcome"), F.col("event_id").alias("at"))
    table.write.parquet(f"{at}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{at}/in")
    flows.retries(stream).writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("append").parquet(f"{at}/out")).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("""WITH c AS (SELECT user_id, max(event_id) FILTER (event_type <> 'error') AS cleared FROM events GROUP BY user_id)
SELECT user_id AS item, count(*)::INT AS fails, count(*) >= 2 AS given_up FROM events JOIN c USING (user_id) WHERE event_type = 'error' AND (cleared IS NULL OR event_id > cleared) GROUP BY user_id""")
def q_retry_counts(spark: SparkSession, d: str) -> DataFrame:
    """The same of a table: only items that have failed since their last success."""
    e = load(spark, d, "events").select(F.col("user_id").alias("item"), F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("outcome"), F.col("event_id").alias("at"))
    return flows.retry_counts(e)


@query("SELECT event_id::VARCHAR AS id, CASE event_id % 5 WHEN 0 THEN 'unsent' ELSE 'sent' END AS state FROM events")
def q_stream_outbox(spark: SparkSession, d: str) -> DataFrame:
    """Answers kept before they are sent, tried once more, and marked unsent if that fails too."""
    at = _own_folder(spark, "outbox")
    table = load(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("answer"))
    table.write.parquet(f"{at}/in")
    calls = []

    def send(rows: DataFrame) -> DataFrame:
        calls.append(1)
        k = F.col("id").cast("bigint")
        return rows.select("id", ((k % 5 != 0) & ((k % 5 != 1) | F.lit(len(calls) % 2 == 0))).alias("sent"))

    flows.drained(spark.readStream.schema(table.schema).parquet(f"{at}/in"), f"{at}/check", flows.outbox(f"{at}/box", send))
    return spark.read.parquet(f"{at}/box/state").select("id", "state")
