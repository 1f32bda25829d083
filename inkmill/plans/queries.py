"""Queries of the core operators, with SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import text as fn
from inkmill.operators import compare, forms, gates, nested, notes, report, search, tables, threads
from inkmill.plans.session import load

NOW = "2026-11-01 00:00:00"
#: Words in names of large collections. Fixed values.
BULK_NAME = "proceedings|abstract|catalog|book|자료집|초록집"
#: Which actions a label asks for. Fixed values.
LABELS = {"inbox/file": (), "inbox/read": (), "list/digest": (), "inbox/schedule": ("schedule",), "inbox/task": ("task",), "inbox/task-reply": ("task", "reply"), "inbox/reply": ("reply",)}
PLAIN = {"BUILDING": "construction", "MACHINERY": "machines"}
PREFIXES = [("NATION_1", "country one-"), ("NATION_", "country "), ("AUTO", "car ")]
TEMPLATE = [("the", "<a>"), ("<a>", "b&c"), ("&amp;amp;", "and")]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- nested structures -----------------------------------------------------------------------------------------


_LINK = "CASE json_type({0}) WHEN 'VARCHAR' THEN {0}->>'$' WHEN 'OBJECT' THEN coalesce({0}->>'$.\"$ref\"', {0}->>'$.cref') END"


_ITEMS_OF = f"""WITH raw AS (SELECT DISTINCT rec_id, json_structure AS s FROM docling WHERE json_valid(json_structure)),
one AS (SELECT rec_id, CASE WHEN json_type(s) = 'VARCHAR' THEN s::JSON->>'$' ELSE s END AS s FROM raw),
doc AS (SELECT rec_id, CASE WHEN json_type(s::JSON->'$.texts') IS NULL AND json_type(s::JSON->'$.document') = 'OBJECT' THEN s::JSON->'$.document' ELSE s::JSON END AS j FROM one WHERE json_valid(s)),
arrays AS (SELECT rec_id, a, unnest(CAST(json_extract(j, '$.' || a) AS JSON[])) AS e, generate_subscripts(CAST(json_extract(j, '$.' || a) AS JSON[]), 1) - 1 AS i FROM doc, (VALUES ('texts'), ('groups'), ('tables'), ('pictures')) v(a) WHERE json_type(json_extract(j, '$.' || a)) = 'ARRAY'),
items AS (SELECT rec_id, a, i, '#/' || a || '/' || i AS item_ref, {_LINK.format("(e->'$.parent')")} AS up, e FROM arrays),
named AS (SELECT rec_id, 0 AS rank, 0 AS i, '#/body' AS who, unnest(CAST(j->'$.body.children' AS JSON[])) AS c FROM doc UNION ALL
SELECT rec_id, list_position(['texts', 'groups', 'tables', 'pictures'], a), i, item_ref, unnest(CAST(e->'$.children' AS JSON[])) FROM items WHERE json_type(e->'$.children') = 'ARRAY'),
children AS (SELECT rec_id, target, arg_min(who, (rank, i)) AS who FROM (SELECT *, {_LINK.format("c")} AS target FROM named) GROUP BY ALL)"""
_PARENT = "FROM items i LEFT JOIN children c ON c.rec_id = i.rec_id AND c.target = i.item_ref"
#: The states of the automaton for what stands in the arrays, in its order.
_VARIANT = """CASE WHEN json_type(e) <> 'OBJECT' THEN 'other' WHEN json_type(e->'$."$ref"') = 'VARCHAR' OR json_type(e->'$.cref') = 'VARCHAR' THEN rtrim(a, 's')
WHEN json_type(e->'$.data') = 'OBJECT' AND json_type(e->'$.data."$ref"') IS NULL THEN 'table' WHEN json_type(e->'$.text') IS NOT NULL AND json_type(e->'$.level') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'heading'
WHEN json_type(e->'$.text') IS NOT NULL AND json_type(e->'$.enumerated') = 'BOOLEAN' THEN 'entry' WHEN json_type(e->'$.text') IS NOT NULL THEN 'text' WHEN json_type(e->'$.captions') IS NOT NULL OR json_type(e->'$.annotations') IS NOT NULL THEN 'picture'
WHEN json_type(e->'$.label') IS NOT NULL AND (json_type(e->'$.name') IS NOT NULL OR json_type(e->'$.children') IS NOT NULL) THEN 'group' ELSE rtrim(a, 's') END"""


def _array(path: str) -> str:
    return f"CASE WHEN json_type({path}) = 'ARRAY' THEN CAST({path} AS JSON[]) ELSE [] END"


@query(_ITEMS_OF + f" SELECT i.rec_id, item_ref, coalesce(up, who, '') AS parent_ref {_PARENT}")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "items").select("rec_id", "item_ref", "parent_ref")


@query(_ITEMS_OF + f" SELECT DISTINCT i.rec_id, item_ref, coalesce(up, who, '') AS parent_ref, a AS item_array, i.i::INT AS item_pos, {_VARIANT} AS variant, e->>'$.label' AS label, e->>'$.name' AS name, len({_array("e->'$.children'")})::INT AS n_children {_PARENT}")
def p4_items(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "items")


@query(_ITEMS_OF + f" SELECT DISTINCT i.rec_id, item_ref, coalesce(up, who, '') AS parent_ref, {_VARIANT} AS variant, try_cast(e->>'$.level' AS INT) AS level, CASE json_type(e->'$.enumerated') WHEN 'BOOLEAN' THEN (e->>'$.enumerated')::BOOLEAN END AS enumerated, e->>'$.text' AS text, e->>'$.orig' AS orig {_PARENT} WHERE json_type(e->'$.text') IS NOT NULL")
def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "texts")


@query(_ITEMS_OF + f""", x AS (SELECT rec_id, item_ref, unnest({_array("e->'$.data.table_cells'")}) AS c, generate_subscripts({_array("e->'$.data.table_cells'")}, 1) - 1 AS k FROM items)
SELECT DISTINCT rec_id, item_ref, k::INT AS cell_pos, try_cast(c->>'$.start_row_offset_idx' AS INT) AS row_no, try_cast(c->>'$.start_col_offset_idx' AS INT) AS col_no, try_cast(coalesce(c->>'$.row_span', '1') AS INT) AS row_span, try_cast(coalesce(c->>'$.col_span', '1') AS INT) AS col_span,
coalesce(c->>'$.column_header', '') = 'true' OR coalesce(c->>'$.row_header', '') = 'true' AS is_header, c->>'$.text' AS text FROM x WHERE json_type(c) = 'OBJECT'""")
def p4_cells(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "cells")


@query(_ITEMS_OF + f""", x AS (SELECT rec_id, item_ref, unnest({_array("e->'$.prov'")}) AS p, generate_subscripts({_array("e->'$.prov'")}, 1) - 1 AS k FROM items)
SELECT DISTINCT rec_id, item_ref, k::INT AS pos_no, try_cast(p->>'$.page_no' AS INT) AS page_no, (p->>'$.bbox.l')::DOUBLE AS l, (p->>'$.bbox.t')::DOUBLE AS t, (p->>'$.bbox.r')::DOUBLE AS r, (p->>'$.bbox.b')::DOUBLE AS b, p->>'$.bbox.coord_origin' AS coord_origin, try_cast(p->>'$.charspan[0]' AS INT) AS char_from, try_cast(p->>'$.charspan[1]' AS INT) AS char_to FROM x WHERE json_type(p) = 'OBJECT'""")
def p4_positions(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "positions")


@query(_ITEMS_OF + f""", x AS (SELECT rec_id, unnest({_array("j->'$.pages'")}) AS p, generate_subscripts({_array("j->'$.pages'")}, 1)::VARCHAR AS k FROM doc UNION ALL
SELECT rec_id, json_extract(pages, '$."' || k || '"'), k FROM (SELECT rec_id, j->'$.pages' AS pages, unnest(json_keys(j->'$.pages')) AS k FROM doc WHERE json_type(j->'$.pages') = 'OBJECT'))
SELECT DISTINCT rec_id, coalesce(try_cast(p->>'$.page_no' AS INT), try_cast(k AS INT)) AS page_no, (p->>'$.size.width')::DOUBLE AS width, (p->>'$.size.height')::DOUBLE AS height FROM x""")
def p4_pages(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten(load(spark, d, "docling"), "pages")


# ---- comparison of two parses ----------------------------------------------------------------------------------

_FEATURES = r"""
WITH raw AS (
  SELECT DISTINCT rec_id, side, rtrim(regexp_replace(coalesce(markdown, ''), '\r\n?', chr(10), 'g')) AS md
  FROM (SELECT rec_id, 'a' AS side, markdown FROM docling UNION ALL SELECT rec_id, 'b', markdown FROM mineru)),
masked AS (
  SELECT *, regexp_extract_all(md, '(?s)<table.*?</table>') AS html,
         regexp_replace(md, '(?s)<table.*?</table>', chr(57344), 'g') AS m FROM raw),
piped AS (
  SELECT *, regexp_extract_all(m, '(?m)^\|[^\n]*\n\|[ \t\-:|]+\|[ \t]*(?:\n\|[^\n]*)*') AS pipes,
         regexp_replace(m, '(?m)^\|[^\n]*\n\|[ \t\-:|]+\|[ \t]*(?:\n\|[^\n]*)*', chr(10) || chr(10), 'g') AS flow FROM masked),
shaped AS (
  SELECT rec_id, side, len(html) + len(pipes) AS n_tables,
    list_distinct(list_transform(regexp_extract_all(flow, '(?m)^#+[ \t]+([^\n]*)', 1), lambda x: trim(x))) AS headings,
    len(list_filter(list_transform(regexp_split_to_array(regexp_replace(flow, '(?m)^(?:#+[ \t]+[^\n]*|\x{E000}[^\n]*)$', chr(10) || chr(10), 'g'), '\n[ \t]*\n'),
        lambda b: trim(regexp_replace(regexp_replace(b, '[ \t]*\n[ \t]*', ' ', 'g'), '^\s+|\s+$', '', 'g'))), lambda b: b <> '')) AS n_paragraphs,
    list_concat(
      flatten(list_transform(html, lambda t: regexp_extract_all(t, '(?s)<t[dh][^>]*>(.*?)</t[dh]>', 1))),
      flatten(list_transform(pipes, lambda t: flatten(list_transform(list_concat([string_split(t, chr(10))[1]], string_split(t, chr(10))[3:]),
        lambda r: string_split(regexp_replace(rtrim(r), '^\|+|\|+$', '', 'g'), '|')))))) AS cells
  FROM piped),
f AS (
  SELECT rec_id, side, headings, n_paragraphs, n_tables,
    list_filter(list_transform(cells, lambda c: regexp_replace(regexp_replace(c, '<[^>]*>', '', 'g'), '[,\s%]', '', 'g')), lambda c: regexp_matches(c, '^-?\d+(\.\d+)?$')) AS numbers
  FROM shaped),
n AS (
  SELECT rec_id, value, count(*) FILTER (side = 'a') AS n_a, count(*) FILTER (side = 'b') AS n_b
  FROM (SELECT rec_id, side, unnest(numbers) AS value FROM f WHERE rec_id IN (SELECT rec_id FROM mineru) AND rec_id IN (SELECT rec_id FROM docling))
  GROUP BY ALL),
m AS (
  SELECT a.rec_id,
    CASE WHEN greatest(len(a.headings), len(b.headings)) = 0 THEN 1.0 ELSE len(list_intersect(a.headings, b.headings)) / greatest(len(a.headings), len(b.headings)) END::DOUBLE AS heading_overlap,
    CASE WHEN greatest(a.n_paragraphs, b.n_paragraphs) = 0 THEN 0.0 ELSE abs(a.n_paragraphs - b.n_paragraphs) / greatest(a.n_paragraphs, b.n_paragraphs) END::DOUBLE AS paragraph_delta,
    CASE WHEN greatest(a.n_tables, b.n_tables) = 0 THEN 1.0 ELSE least(a.n_tables, b.n_tables) / greatest(a.n_tables, b.n_tables) END::DOUBLE AS table_match,
    CASE WHEN greatest(len(a.numbers), len(b.numbers)) = 0 THEN 1.0 ELSE coalesce((SELECT sum(least(n_a, n_b)) FROM n WHERE n.rec_id = a.rec_id), 0) / greatest(len(a.numbers), len(b.numbers)) END::DOUBLE AS numeric_match,
    len(a.headings)::INT AS headings_a, len(b.headings)::INT AS headings_b, a.n_paragraphs::INT AS paragraphs_a, b.n_paragraphs::INT AS paragraphs_b,
    a.n_tables::INT AS tables_a, b.n_tables::INT AS tables_b, len(a.numbers)::INT AS numbers_a, len(b.numbers)::INT AS numbers_b
  FROM f a JOIN f b ON a.rec_id = b.rec_id AND a.side = 'a' AND b.side = 'b')
"""


@query(_FEATURES + "SELECT rec_id, n_paragraphs::INT AS n_paragraphs, n_tables::INT AS n_tables, len(headings)::INT AS n_headings, len(numbers)::INT AS n_numbers FROM f WHERE side = 'a'")
def q_norm_docs(spark: SparkSession, d: str) -> DataFrame:
    return compare.profiles(load(spark, d, "docling")).select("rec_id", "n_paragraphs", "n_tables", F.size("headings").alias("n_headings"), F.size("numbers").alias("n_numbers"))


@query(_FEATURES + "SELECT *, CASE WHEN heading_overlap >= 0.8 AND paragraph_delta <= 0.2 AND table_match >= 0.8 AND numeric_match >= 0.95 THEN 'agree' ELSE 'diverge' END AS verdict FROM m")
def q_pair_verdict(spark: SparkSession, d: str) -> DataFrame:
    return compare.metrics(load(spark, d, "docling"), load(spark, d, "mineru"))


@query(_FEATURES + """, s AS (SELECT rec_id, value, CASE WHEN n_a > n_b THEN 'a_only' ELSE 'b_only' END AS side, abs(n_a - n_b) AS surplus FROM n WHERE n_a <> n_b)
SELECT rec_id, side, value, surplus, place FROM (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY surplus DESC, side, value)::INT AS place FROM s) WHERE place <= 10""")
def q_mismatch_top10(spark: SparkSession, d: str) -> DataFrame:
    return compare.mismatches(load(spark, d, "docling"), load(spark, d, "mineru"))


@query(_FEATURES + """, h AS (SELECT a.rec_id, unnest([{'side': 'a', 'h': list_filter(a.headings, lambda x: NOT list_contains(b.headings, x))}, {'side': 'b', 'h': list_filter(b.headings, lambda x: NOT list_contains(a.headings, x))}], recursive := true)
  FROM f a JOIN f b ON a.rec_id = b.rec_id AND a.side = 'a' AND b.side = 'b'), e AS (SELECT rec_id, side, unnest(h) AS heading FROM h)
SELECT rec_id, side, heading, place FROM (SELECT *, row_number() OVER (PARTITION BY rec_id, side ORDER BY heading)::INT AS place FROM e) WHERE place <= 10""")
def q_heading_diff(spark: SparkSession, d: str) -> DataFrame:
    return compare.heading_differences(load(spark, d, "docling"), load(spark, d, "mineru"))


@query(r"""WITH w AS (SELECT DISTINCT rec_id, side, unnest(string_split_regex(lower(md), '[^\p{L}\p{N}]+')) AS word, generate_subscripts(string_split_regex(lower(md), '[^\p{L}\p{N}]+'), 1) AS i
  FROM (SELECT DISTINCT rec_id, side, coalesce(md, '') AS md FROM (SELECT rec_id, 'a' AS side, markdown AS md FROM docling UNION ALL SELECT rec_id, 'b', markdown FROM mineru))),
c AS (SELECT rec_id, word, count(*) FILTER (side = 'a') AS n_a, count(*) FILTER (side = 'b') AS n_b FROM w WHERE word <> '' AND rec_id IN (SELECT rec_id FROM mineru) GROUP BY ALL)
SELECT rec_id, sum(least(n_a, n_b))::BIGINT AS shared, sum(greatest(n_a - n_b, 0))::BIGINT AS only_a, sum(greatest(n_b - n_a, 0))::BIGINT AS only_b FROM c GROUP BY rec_id""")
def q_word_multisets(spark: SparkSession, d: str) -> DataFrame:
    """INTERSECT ALL and EXCEPT ALL of the words of two parses, as counts."""

    def words(name: str, n: str) -> DataFrame:
        t = load(spark, d, name).select("rec_id", "markdown").dropDuplicates(["rec_id"])
        return t.select("rec_id", F.explode(F.split(F.lower("markdown"), r"[^\p{L}\p{N}]+")).alias("word")).where("word != ''").groupBy("rec_id", "word").agg(F.count("*").alias(n))

    a = words("docling", "n_a").join(load(spark, d, "mineru").select("rec_id"), "rec_id", "left_semi")
    both = a.join(words("mineru", "n_b"), ["rec_id", "word"], "full").na.fill(0, ["n_a", "n_b"])
    return both.groupBy("rec_id").agg(F.sum(F.least("n_a", "n_b")).alias("shared"), F.sum(F.greatest(F.col("n_a") - F.col("n_b"), F.lit(0))).alias("only_a"), F.sum(F.greatest(F.col("n_b") - F.col("n_a"), F.lit(0))).alias("only_b"))


# ---- gates, ledgers, caps --------------------------------------------------------------------------------------


@query(r"""WITH c AS (SELECT DISTINCT path, contains(path, '00_inbox/') AS inbox FROM source_file WHERE regexp_extract(path, '\.([^./]+)$', 1) IN ('pdf', 'docx') AND NOT contains(path, '_parse/') AND NOT contains(path, '/_hold/'))
SELECT path, inbox, row_number() OVER (ORDER BY inbox DESC, path) AS place FROM c""")
def q_candidates(spark: SparkSession, d: str) -> DataFrame:
    return gates.candidates(load(spark, d, "source_file"), ["pdf", "docx"])


@query(r"""SELECT route, count(*) AS files FROM (SELECT DISTINCT path, CASE WHEN e IN ('hwp', 'hwpx', 'doc', 'rtf', 'odt') THEN 'docx' WHEN e IN ('ppt', 'odp') THEN 'pptx' WHEN e IN ('xls', 'ods') THEN 'xlsx' ELSE e END AS route
FROM (SELECT path, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS e FROM source_file)) GROUP BY route""")
def q_router(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "source_file").select("path", gates.route(F.col("path")).alias("route")).distinct().groupBy("route").agg(F.count("*").alias("files"))


_BULK = rf"""CASE WHEN pages IS NOT NULL THEN pages >= 100 OR (regexp_matches(regexp_extract(path, '([^/]+)$', 1), '(?i){BULK_NAME}') AND pages >= 40)
ELSE coalesce(length // 1048576 >= 20 OR (regexp_matches(regexp_extract(path, '([^/]+)$', 1), '(?i){BULK_NAME}') AND length // 1048576 >= 8), false) END"""


@query(f"SELECT DISTINCT path, length, pages, {_BULK} AS bulk FROM source_file")
def q_bulk_gate(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "source_file").select("path", "length", "pages", gates.bulk(F.col("path"), F.col("length"), F.col("pages"), BULK_NAME).alias("bulk")).distinct()


_STATES = f"""s AS (SELECT path, CASE min(k) WHEN 1 THEN 'done' WHEN 2 THEN 'bulk' WHEN 3 THEN 'failed' ELSE 'attempt' END AS state FROM
(SELECT path, CASE WHEN path IN (SELECT pdf_path FROM mineru) THEN 1 WHEN {_BULK} THEN 2 WHEN path IN (SELECT source FROM parse_error WHERE source IS NOT NULL) THEN 3 ELSE 4 END AS k FROM source_file) GROUP BY path)"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    return gates.states(load(spark, d, "source_file"), load(spark, d, "mineru").select(F.col("pdf_path").alias("path")), load(spark, d, "parse_error").select(F.col("source").alias("path")), BULK_NAME)


@query(f"WITH {_STATES} SELECT path, state FROM s")
def q_gate_states(spark: SparkSession, d: str) -> DataFrame:
    return _states(spark, d)


@query(rf"""WITH {_STATES}, a AS (SELECT path, contains(path, '00_inbox/') AS inbox, CASE WHEN e IN ('hwp', 'hwpx') THEN 1 WHEN e IN ('xls', 'xlsx') THEN 2 WHEN e IN ('pdf', 'docx', 'pptx', 'doc') THEN 3 WHEN e IN ('png', 'jpg', 'jpeg') THEN 4 WHEN e IN ('m4a', 'mp3', 'wav') THEN 5 ELSE 9 END AS lane
FROM (SELECT *, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS e FROM s WHERE state = 'attempt'))
SELECT path, inbox, lane FROM a WHERE inbox UNION ALL (SELECT path, inbox, lane FROM a WHERE NOT inbox ORDER BY lane, path LIMIT 5)""")
def q_backlog_cap(spark: SparkSession, d: str) -> DataFrame:
    return gates.admitted(_states(spark, d).where("state = 'attempt'"), 5)


@query("""SELECT o_orderkey, spent_before FROM (SELECT o_orderkey, coalesce(sum(o_totalprice::DECIMAL(15, 2)) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent_before FROM orders) WHERE spent_before < 5000000""")
def q_budget_cutoff(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"))
    return gates.within_budget(orders, [F.asc("o_orderkey")], F.col("price"), 5_000_000).select("o_orderkey", "spent_before")


@query(r"""SELECT DISTINCT path, length FROM source_file WHERE lower(regexp_extract(path, '\.([^./]+)$', 1)) IN ('m4a', 'mp3', 'wav') AND regexp_extract(path, '([^/]+)$', 1) || ':' || length NOT IN (SELECT trim(ledger_key) FROM ledger WHERE ledger_key IS NOT NULL)""")
def q_ledger_anti(spark: SparkSession, d: str) -> DataFrame:
    audio = load(spark, d, "source_file").select("path", "length").where(fn.extension(F.col("path")).isin("m4a", "mp3", "wav")).distinct()
    return gates.not_in_ledger(audio, load(spark, d, "ledger"), F.concat_ws(":", fn.base_name(F.col("path")), F.col("length").cast("string")))


@query("SELECT DISTINCT source FROM parse_error WHERE source IN (SELECT path FROM source_file WHERE path IS NOT NULL)")
def q_ledger_semi(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "parse_error").select("source").distinct().join(load(spark, d, "source_file").select(F.col("path").alias("source")), "source", "left_semi")


@query("""WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE text IS NOT NULL), g AS (SELECT h, min(doc_id) AS kept FROM h GROUP BY h HAVING count(*) > 1)
SELECT doc_id, kept FROM h JOIN g USING (h) WHERE doc_id <> kept""")
def q_exact_prune(spark: SparkSession, d: str) -> DataFrame:
    return gates.prune_copies(load(spark, d, "documents"), "doc_id", "text")


@query("""SELECT source, count(*) AS fails, max(seen_at) AS last_seen, arg_max(reason, (seen_at, reason)) AS reason, count(*) >= 2 AS given_up FROM (SELECT DISTINCT * FROM parse_error WHERE reason IS NOT NULL) GROUP BY source""")
def q_fail_ledger(spark: SparkSession, d: str) -> DataFrame:
    return gates.failures(load(spark, d, "parse_error"))


@query("""SELECT source, stage, m.host AS host, m.reason AS reason, m.seen_at AS seen_at FROM (SELECT source, stage, max({'seen_at': seen_at, 'host': coalesce(host, ''), 'reason': coalesce(reason, '')}) AS m FROM parse_error WHERE stage IS NOT NULL GROUP BY ALL)""")
def q_error_state(spark: SparkSession, d: str) -> DataFrame:
    return gates.latest_markers(load(spark, d, "parse_error"))


@query(r"""SELECT path, CASE WHEN n = 0 THEN name ELSE regexp_extract(name, '^(.*?)(\.[^.]*)?$', 1) || '_' || n || regexp_extract(name, '^(.*?)(\.[^.]*)?$', 2) END AS dest
FROM (SELECT path, regexp_extract(path, '([^/]+)$', 1) AS name, row_number() OVER (PARTITION BY regexp_extract(path, '([^/]+)$', 1) ORDER BY path) - 1 AS n FROM (SELECT DISTINCT path FROM source_file))""")
def q_unique_dest(spark: SparkSession, d: str) -> DataFrame:
    files = load(spark, d, "source_file").select("path").distinct().withColumn("name", fn.base_name(F.col("path")))
    return gates.unique_names(files, "name", "path").select("path", "dest")


@query(r"""SELECT source, stage, reason, CASE WHEN regexp_matches(reason, '(?i)rate.?limit|usage limit|too many requests|quota exceeded|\b429\b') THEN 'wait' WHEN regexp_matches(reason, '(?i)timeout') THEN 'retry' ELSE 'report' END AS handling, nullif(regexp_extract(reason, 'after (\d+)s', 1), '')::INT AS seconds
FROM (SELECT DISTINCT source, stage, reason FROM parse_error WHERE reason IS NOT NULL)""")
def q_failure_kinds(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "parse_error").select("source", "stage", "reason").where("reason IS NOT NULL").distinct()
    handling = F.when(report.rate_limited(F.col("reason")), "wait").when(F.col("reason").rlike("(?i)timeout"), "retry").otherwise("report")
    return e.withColumn("handling", handling).withColumn("seconds", F.nullif(F.regexp_extract("reason", r"after (\d+)s", 1), F.lit("")).cast("int"))


# ---- reports ---------------------------------------------------------------------------------------------------

_EVENT = "SELECT *, CASE event_type WHEN 'error' THEN 'fail' WHEN 'view' THEN 'warn' ELSE 'ok' END AS status FROM events"


def _observed(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").withColumn("status", F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "view", "warn").otherwise("ok"))


@query(f"""SELECT user_id, passed, warned, failed, warned = 0 AND failed = 0 AS ok, CASE WHEN failed > 0 THEN 1 WHEN warned > 0 THEN 2 ELSE 0 END AS exit_code FROM
(SELECT user_id, count(*) FILTER (status = 'ok') AS passed, count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status = 'fail') AS failed FROM ({_EVENT}) GROUP BY user_id)""")
def q_status_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.summary(_observed(spark, d), "user_id")


_ITEMS = "SELECT coalesce(stage, '?') AS section, coalesce(host, '?') AS label, count(*) AS n, CASE WHEN count(*) > 60 THEN 'fail' WHEN count(*) > 45 THEN 'warn' ELSE 'ok' END AS status FROM (SELECT DISTINCT * FROM parse_error) GROUP BY ALL"


def _items(spark: SparkSession, d: str) -> DataFrame:
    """The items of one report: as many rows as there are stages and hosts."""
    e = load(spark, d, "parse_error").distinct()
    g = e.groupBy(F.coalesce("stage", F.lit("?")).alias("section"), F.coalesce("host", F.lit("?")).alias("label")).agg(F.count("*").alias("n"))
    return g.withColumn("status", F.when(F.col("n") > 60, "fail").when(F.col("n") > 45, "warn").otherwise("ok"))


_NUMBERED = f"SELECT *, dense_rank() OVER (ORDER BY section) || '-' || row_number() OVER (ORDER BY section, label) AS no FROM ({_ITEMS})"


@query(_NUMBERED)
def q_numbered_items(spark: SparkSession, d: str) -> DataFrame:
    return report.numbered(_items(spark, d), "section", ["label"])


@query(f"SELECT no || ' ' || label || ' [' || status || ']' || CASE WHEN status <> 'ok' THEN ' - ' || n || ' failures' ELSE '' END AS line FROM ({_NUMBERED})")
def q_report_lines(spark: SparkSession, d: str) -> DataFrame:
    items = report.numbered(_items(spark, d), "section", ["label"])
    return items.select(report.line(F.col("no"), F.col("label"), F.col("status"), F.concat(F.col("n").cast("string"), F.lit(" failures"))).alias("line"))


@query(f"""SELECT status, count(*) AS total, array_to_string(list(no ORDER BY label, section)[1:12], ', ') AS numbers FROM ({_NUMBERED}) GROUP BY status""")
def q_problem_refs(spark: SparkSession, d: str) -> DataFrame:
    items = report.numbered(_items(spark, d), "section", ["label"]).withColumn("at", F.concat_ws("\x00", "label", "section"))
    return report.references(items, "status", "no", "at")


@query("""WITH c AS (SELECT coalesce(stage, '?') AS stage, source, count(*) AS n FROM (SELECT DISTINCT * FROM parse_error) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY n DESC, source) AS place FROM c)
SELECT stage, place::INT AS place, source, n FROM r WHERE place <= 5 UNION ALL SELECT stage, 6, '... ' || count(*) || ' more', sum(n)::BIGINT FROM r WHERE place > 5 GROUP BY stage""")
def q_topn_rest(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "parse_error").distinct().groupBy(F.coalesce("stage", F.lit("?")).alias("stage"), "source").agg(F.count("*").alias("n"))
    return report.top_and_rest(c, "stage", "source", "n")


@query("""SELECT user_id, epoch(TIMESTAMP '2024-02-01' - max(ts)) / 86400 AS age, CASE WHEN epoch(TIMESTAMP '2024-02-01' - max(ts)) / 86400 > 3 THEN 'fail' WHEN epoch(TIMESTAMP '2024-02-01' - max(ts)) / 86400 > 1 THEN 'warn' ELSE 'ok' END AS status FROM events GROUP BY user_id""")
def q_stale_age(spark: SparkSession, d: str) -> DataFrame:
    last = load(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("ts")).select("user_id", fn.age_days(F.col("ts"), "2024-02-01 00:00:00").alias("age"))
    return last.withColumn("status", F.when(F.col("age") > 3, "fail").when(F.col("age") > 1, "warn").otherwise("ok"))


@query("""WITH l AS (SELECT DISTINCT c_mktsegment AS label FROM customer UNION SELECT n_name FROM nation UNION SELECT r_name FROM region)
SELECT label, CASE WHEN label = 'BUILDING' THEN 'construction' WHEN label = 'MACHINERY' THEN 'machines' WHEN starts_with(label, 'NATION_1') THEN 'country one-' || label[9:] WHEN starts_with(label, 'NATION_') THEN 'country ' || label[8:] WHEN starts_with(label, 'AUTO') THEN 'car ' || label[5:] ELSE label END AS plain FROM l""")
def q_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    labels = load(spark, d, "customer").select(F.col("c_mktsegment").alias("label")).union(load(spark, d, "nation").select("n_name")).union(load(spark, d, "region").select("r_name")).distinct()
    return report.plain_labels(labels, "label", PLAIN, PREFIXES)


@query("SELECT user_id, event_type, min(event_id) AS first_id FROM events GROUP BY ALL")
def q_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_id"))


@query("""SELECT user_id, last_type, CASE WHEN NOT enabled THEN 'warn' WHEN last_type = 'purchase' THEN 'ok' WHEN last_type IN ('view', 'click') THEN 'warn' ELSE 'fail' END AS status, enabled AND last_ts < TIMESTAMP '2024-01-30' - INTERVAL 1 HOUR AS stuck,
CASE WHEN days IS NULL THEN 'warn' WHEN days <= 0 THEN 'fail' WHEN days < 7 THEN 'warn' ELSE 'ok' END AS expiry FROM
(SELECT user_id, arg_max(event_type, event_id) AS last_type, max(ts) AS last_ts, user_id % 10 <> 0 AS enabled, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 20 - 3 END AS days FROM events GROUP BY user_id)""")
def q_schedules(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"), F.max("ts").alias("last_ts"))
    enabled = F.col("user_id") % 10 != 0
    named = F.when(F.col("last_type") == "purchase", "ok").when(F.col("last_type").isin("view", "click"), "running").otherwise(F.col("last_type"))
    days = F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 20 - 3)
    return e.select("user_id", "last_type", report.schedule_status(enabled, named).alias("status"), report.stuck(enabled, F.col("last_ts"), F.lit("2024-01-30").cast("timestamp_ntz")).alias("stuck"), report.expiry_status(days).alias("expiry"))


# ---- mail threads ----------------------------------------------------------------------------------------------

_CAPTURE = """WITH cap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY len(messages) DESC, captured_at DESC, coalesce(label, '') DESC) AS k FROM thread WHERE messages IS NOT NULL) WHERE k = 1),
each AS (SELECT tid, generate_subscripts(messages, 1) - 1 AS pos, unnest(messages) AS m FROM cap),
msg AS (SELECT tid, m.id AS msg_id, min(pos) AS pos, arg_min(coalesce(try_cast(m.internalDate AS BIGINT), 0), pos) AS sent, arg_min(m.payload, pos) AS payload FROM each GROUP BY tid, m.id)"""


def _captures(spark: SparkSession, d: str) -> DataFrame:
    return threads.newest_capture(load(spark, d, "thread").where("messages IS NOT NULL"))


@query(_CAPTURE + " SELECT tid, count(*) AS n, max(sent) AS last_sent, arg_max(msg_id, (sent, -pos)) AS newest, arg_max(msg_id, (sent, pos)) AS newest_last FROM msg GROUP BY tid")
def q_latest_ties(spark: SparkSession, d: str) -> DataFrame:
    return threads.index(_captures(spark, d))


def _head_sql(name: str) -> str:
    return f"coalesce(list_filter(CAST(payload->'$.headers' AS STRUCT(name VARCHAR, value VARCHAR)[]), lambda h: lower(h.name) = '{name}')[-1].value, '')"


@query(_CAPTURE + f" SELECT msg_id, {_head_sql('from')} AS sender, {_head_sql('to')} AS receiver, {_head_sql('subject')} AS subject, CASE WHEN starts_with(lower({_head_sql('subject')}), 're:') THEN {_head_sql('subject')} ELSE 'Re: ' || {_head_sql('subject')} END AS reply FROM msg")
def q_mail_headers(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("payload")
    subject = threads.header(p, "subject")
    return threads.messages(_captures(spark, d)).select("msg_id", threads.header(p, "from").alias("sender"), threads.header(p, "to").alias("receiver"), subject.alias("subject"), fn.reply_subject(subject).alias("reply"))


@query()
def q_thread_doc(spark: SparkSession, d: str) -> DataFrame:
    return threads.documents(_captures(spark, d))


@query(_CAPTURE + """, kept AS (SELECT tid, arg_min(folder, folder) AS folder, arg_min(coalesce(message_count, -1), folder) AS message_count FROM capture_state GROUP BY tid),
n AS (SELECT tid, count(*) AS n FROM msg GROUP BY tid)
SELECT tid, folder, CASE WHEN folder IS NULL THEN 'new' WHEN message_count = n THEN 'skip' ELSE 'overwrite' END AS action FROM n LEFT JOIN kept USING (tid)""")
def q_thread_upsert(spark: SparkSession, d: str) -> DataFrame:
    return threads.upserts(threads.index(_captures(spark, d)).select("tid", "n"), load(spark, d, "capture_state"))


_DISPATCH = """, w AS (SELECT tid, CASE label WHEN 'inbox/schedule' THEN ['schedule'] WHEN 'inbox/task' THEN ['task'] WHEN 'inbox/task-reply' THEN ['task', 'reply'] WHEN 'inbox/reply' THEN ['reply'] ELSE []::VARCHAR[] END AS a FROM cap),
steps AS (SELECT tid, generate_subscripts(a, 1)::INT AS step, unnest(a) AS action FROM w)"""


@query(_CAPTURE + _DISPATCH + " SELECT tid, step, action FROM steps")
def q_action_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return threads.dispatch(_captures(spark, d).select("tid", "label"), LABELS)


@query(_CAPTURE + _DISPATCH + " SELECT tid, step, action FROM steps WHERE (tid, action) NOT IN (SELECT tid, unnest(map_keys(actions)) FROM capture_state)")
def q_pending_actions(spark: SparkSession, d: str) -> DataFrame:
    return threads.pending(threads.dispatch(_captures(spark, d).select("tid", "label"), LABELS), load(spark, d, "capture_state")).select("tid", "step", "action")


_SLUG = r"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '^[\s\x0b]+|[\s\x0b]+$', '', 'g'), '[\s\x0b]+', '-', 'g'), '[\\/:*?\"<>|]', '', 'g'), '^[-. ]+|[-. ]+$', '', 'g')[1:{1}], ''), 'no-subject')"


@query("SELECT doc_id, " + _SLUG.format("text", 50) + " AS slug FROM documents")
def q_slug(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", fn.slug(F.col("text")).alias("slug"))


# ---- text and forms --------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '\[\[[^\]|#\n]+')) AS links, len(list_distinct(regexp_extract_all(text, '\[\[([^\]|#\n]+)', 1))) AS targets FROM documents WHERE text IS NOT NULL""")
def q_note_links(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#\n]+)"), F.lit(1))
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(found).cast("bigint").alias("links"), F.size(F.array_distinct(found)).cast("bigint").alias("targets"))


@query(r"""WITH b AS (SELECT doc_id, regexp_extract(text, '(?s)^---\n(.*?)\n---', 1) AS block FROM documents WHERE text IS NOT NULL)
SELECT doc_id, trim(regexp_extract(block, '(?m)^title:(.*)$', 1), ' ') AS title, trim(regexp_extract(block, '(?m)^para:(.*)$', 1), ' ') AS para FROM b WHERE block <> ''""")
def q_front_matter(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", fn.front_matter(F.col("text")).alias("m")).where("m IS NOT NULL")
    return m.select("doc_id", F.coalesce(F.try_element_at("m", F.lit("title")), F.lit("")).alias("title"), F.coalesce(F.try_element_at("m", F.lit("para")), F.lit("")).alias("para"))


@query(r"""WITH y AS (SELECT doc_id, regexp_extract(text, '(?s)```yaml\n(.*?)\n```', 1) AS y FROM documents WHERE text IS NOT NULL)
SELECT doc_id, generate_subscripts(k, 1)::INT AS place, unnest(k) AS key FROM (SELECT doc_id, regexp_extract_all(y, '(?m)^([A-Za-z_]\w*):', 1) AS k FROM y)""")
def q_yaml_keys(spark: SparkSession, d: str) -> DataFrame:
    block = F.regexp_extract("text", r"(?s)```yaml\n(.*?)\n```", 1)
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.regexp_extract_all(block, F.lit(r"(?m)^([A-Za-z_]\w*):"), F.lit(1))).alias("place", "key")).withColumn("place", F.col("place") + 1)


@query(r"""SELECT rec_id, len(regexp_extract_all(md, '(?s)```.*?```'))::INT AS n, md5(regexp_replace(md, '(?s)```.*?```', '', 'g')) AS rest FROM (SELECT DISTINCT rec_id, markdown AS md FROM docling WHERE markdown IS NOT NULL)""")
def q_block_strip(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "docling").where("markdown IS NOT NULL").select("rec_id", forms.strip_blocks(F.col("markdown"), r"(?s)```.*?```").alias("s"))
    return s.select("rec_id", F.col("s.n").alias("n"), F.md5("s.text").alias("rest")).distinct()


@query("""SELECT doc_id, ((length(text) - length(replace(text, 'the', ''))) // 3)::INT AS n, md5(replace(replace(replace(text, 'the', '&lt;a&gt;'), '<a>', 'b&amp;c'), '&amp;amp;', 'and')) AS filled FROM documents WHERE text IS NOT NULL""")
def q_literal_fill(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", forms.occurrences(F.col("text"), "the").alias("n"), F.md5(forms.fill(F.col("text"), TEMPLATE)).alias("filled"))


@query(r"""WITH t AS (SELECT DISTINCT rec_id, regexp_replace(markdown, '\r\n?', chr(10), 'g') AS md FROM docling WHERE markdown IS NOT NULL),
s AS (SELECT rec_id, regexp_extract_all(md, '(?s)```.*?```') AS k, string_split(regexp_replace(md, '(?s)```.*?```', chr(1), 'g'), chr(1)) AS p FROM t)
SELECT rec_id, md5(array_to_string(list_transform(range(1, len(p) + 1), lambda i: regexp_replace(p[i], '(?m)^<!--[^\n]*-->\n?', '', 'g') || coalesce(k[i], '')), '')) AS cleaned FROM s""")
def q_masked_clean(spark: SparkSession, d: str) -> DataFrame:
    md = fn.even_lines(F.col("markdown"))
    cleaned = forms.outside(md, r"(?s)```.*?```", lambda p: F.regexp_replace(p, r"(?m)^<!--[^\n]*-->\n?", ""))
    return load(spark, d, "docling").where("markdown IS NOT NULL").select("rec_id", F.md5(cleaned).alias("cleaned")).distinct()


@query(r"""SELECT doc_id, len(string_split(t, chr(10)))::INT AS lines, md5(CASE WHEN contains(t, chr(10)) THEN array_to_string(list_transform(string_split(t, chr(10)), lambda x: '<hp:p id="1"><hp:t>' || x || '</hp:t></hp:p>'), '') ELSE '<hp:p id="1"><hp:t>' || t || '</hp:t></hp:p>' END) AS split
FROM (SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM documents WHERE text IS NOT NULL)""")
def q_multiline_split(spark: SparkSession, d: str) -> DataFrame:
    part = F.concat(F.lit('<hp:p id="1"><hp:t>'), fn.xml_escape(F.col("text")), F.lit("</hp:t></hp:p>"))
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(F.split("text", "\n")).alias("lines"), F.md5(forms.split_lines(part)).alias("split"))


@query(r"""WITH s AS (SELECT doc_id, text, regexp_extract_all(text, '\[\[([^\]|#\n]+)\]\]', 1) AS k, regexp_extract_all(text, '\[\[[^\]|#\n]+\]\]') AS w, string_split(regexp_replace(text, '\[\[([^\]|#\n]+)\]\]', chr(1), 'g'), chr(1)) AS b FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, k, w, b, generate_subscripts(k, 1) AS i, unnest(k) AS key FROM s),
p AS (SELECT *, (list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0))::INT AS at FROM e WHERE list_position(k, key) = i)
SELECT p.doc_id, (i - 1)::INT AS place, key, p."at" AS "at", regexp_extract_all(substr(d.text, greatest(p."at" - 499, 1), least(p."at", 500)), '\[([^\]]+)\]', 1)[-1] AS label FROM p JOIN documents d USING (doc_id)""")
def q_placeholder_keys(spark: SparkSession, d: str) -> DataFrame:
    return forms.placeholders(load(spark, d, "documents").where("text IS NOT NULL"), "doc_id", "text", r"\[\[([^\]|#\n]+)\]\]")


@query("SELECT p_partkey, p_size AS at, CASE WHEN p_size >= 20 AND p_size < 25 THEN 2 WHEN p_size >= 10 AND p_size < 30 THEN 1 ELSE 0 END AS depth FROM part")
def q_depth_interval(spark: SparkSession, d: str) -> DataFrame:
    points = load(spark, d, "part").select(F.lit(1).alias("doc"), "p_partkey", F.col("p_size").alias("at"))
    spans = spark.createDataFrame([(1, 0, 50, 0), (1, 10, 30, 1), (1, 20, 25, 2)], "doc int, s int, e int, depth int")
    return forms.deepest(points, spans, "doc", 16).drop("doc")


@query(r"""WITH r AS (SELECT [r_regionkey::VARCHAR, r_name] AS c, r_regionkey AS k FROM region)
SELECT '| key | name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || c[1] || ' | ' || c[2] || ' |', chr(10) ORDER BY k) AS md FROM r""")
def q_md_table(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "region").agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("r"))
    cells = F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), F.transform("r", lambda x: F.array(x.r_regionkey.cast("string"), x.r_name)))
    return rows.select(tables.table_text(cells).alias("md"))


@query("""SELECT event_id, (props::JSON->>'$.k')::INT AS k, CASE WHEN event_id % 3 = 0 THEN 'whole' ELSE 'inside' END AS how FROM events WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, NULL, 'broken' FROM events WHERE event_id % 5 = 0""")
def q_json_loose(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").withColumn("said", F.when(F.col("event_id") % 5 == 0, F.regexp_replace("props", r"\}$", "")).when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(F.concat(F.lit("Sure: ```json\n"), F.col("props"), F.lit("\n``` done"))))
    v = fn.loose_json(F.col("said"))
    how = F.when(v.isNull(), "broken").when(F.try_parse_json("said").isNotNull(), "whole").otherwise("inside")
    return e.select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"), how.alias("how"))


@query(r"""SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600)::VARCHAR || ':' ELSE '' END || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS clock, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS seoul
FROM (SELECT event_id, ts, floor(value * 100)::BIGINT AS s FROM events WHERE value IS NOT NULL)""")
def q_clock_times(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").where("value IS NOT NULL")
    return e.select("event_id", fn.clock(F.floor(F.col("value") * 100)).alias("clock"), fn.seoul(F.col("ts").cast("timestamp").cast("string")).alias("seoul"))


# ---- search ----------------------------------------------------------------------------------------------------


@query(r"""WITH w AS (SELECT doc_id AS id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> ''))) AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT a.id AS query, b.id AS hit, count(*) AS shared FROM w a JOIN w b USING (w) WHERE a.id % 100 = 0 AND a.id <> b.id GROUP BY ALL)
SELECT query, hit, shared, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY shared DESC, hit)::INT AS place FROM s) WHERE place <= 5""")
def q_topk_terms(spark: SparkSession, d: str) -> DataFrame:
    return search.by_terms(load(spark, d, "documents"), "doc_id", "text")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT a.vec_id AS query, b.vec_id AS hit, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0)
SELECT query, hit, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, hit)::INT AS place FROM s) WHERE place <= 5""")
def q_topk_cosine(spark: SparkSession, d: str) -> DataFrame:
    return search.by_cosine(load(spark, d, "embeddings"), "vec_id", "embedding")


# ---- notes, phases, counterparts -------------------------------------------------------------------------------


@query(r"""WITH p AS (SELECT DISTINCT pdf_path AS path, 'diff.json' AS a FROM mineru UNION SELECT DISTINCT pdf_path, 'docling.json' FROM docling), a AS (SELECT path, list(a) AS a FROM p GROUP BY path),
f AS (SELECT DISTINCT path, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS e FROM source_file)
SELECT path, coalesce(CASE WHEN e = 'pdf' THEN list_contains(a, 'diff.json') WHEN e IN ('hwp', 'hwpx', 'xls', 'xlsx', 'm4a', 'mp3', 'wav') THEN list_contains(a, 'refined.md') WHEN e IN ('png', 'jpg', 'jpeg') THEN list_contains(a, 'ocr.json') ELSE list_contains(a, 'docling.json') OR list_contains(a, 'refined.md') END, false) AS done FROM f LEFT JOIN a USING (path)""")
def q_done_by_format(spark: SparkSession, d: str) -> DataFrame:
    made = load(spark, d, "mineru").select(F.col("pdf_path").alias("path"), F.lit("diff.json").alias("a")).union(load(spark, d, "docling").select("pdf_path", F.lit("docling.json")))
    artefacts = made.groupBy("path").agg(F.collect_set("a").alias("a"))
    return load(spark, d, "source_file").select("path").distinct().join(artefacts, "path", "left").select("path", gates.is_done(F.col("path"), F.col("a")).alias("done"))


@query(r"""SELECT phase, count(*) AS n FROM (SELECT CASE WHEN engine_action IN ('promote', 'refine') THEN 'refine' WHEN NOT taken_up AND NOT regexp_matches(path, '(?i)\.(m4a|mp3|wav|ogg|opus|aac|amr)$') THEN 'take_up' WHEN ready THEN 'renew' ELSE 'none' END AS phase
FROM (SELECT path, CASE length % 4 WHEN 0 THEN 'promote' WHEN 1 THEN 'refine' ELSE 'keep' END AS engine_action, length % 3 = 0 AS taken_up, length % 5 = 0 AS ready FROM source_file)) GROUP BY phase""")
def q_phases(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("length")
    items = load(spark, d, "source_file").select("path", F.when(n % 4 == 0, "promote").when(n % 4 == 1, "refine").otherwise("keep").alias("action"), (n % 3 == 0).alias("taken_up"), (n % 5 == 0).alias("ready"))
    return gates.phases(items).groupBy("phase").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT DISTINCT replace(pdf_path, 'sources/', 'knowledge/') AS p FROM mineru) SELECT DISTINCT path FROM source_file WHERE replace(path, 'sources/', 'knowledge/') IN (SELECT p FROM k)""")
def q_counterparts(spark: SparkSession, d: str) -> DataFrame:
    others = load(spark, d, "mineru").select(F.regexp_replace("pdf_path", "sources/", "knowledge/").alias("path"))
    files = load(spark, d, "source_file").select("path").distinct()
    return files.join(others.select(F.col("path").alias("o")).distinct(), gates.mirrored(F.col("path"), "sources/", "knowledge/") == F.col("o"), "left_semi")


@query("SELECT DISTINCT pdf_path AS path FROM docling WHERE pdf_path NOT IN (SELECT pdf_path FROM mineru WHERE pdf_path IS NOT NULL)")
def q_missing_second_parse(spark: SparkSession, d: str) -> DataFrame:
    return gates.missing(load(spark, d, "docling").select(F.col("pdf_path").alias("path")), load(spark, d, "mineru").select(F.col("pdf_path").alias("path")), "path")


@query(r"""SELECT event_id, strftime(ts, '%Y') AS year, (props::JSON->>'$.k')::INT AS first FROM events WHERE event_id % 4 <> 3""")
def q_answer_lists(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    keys = F.element_at(F.array(F.lit("files"), F.lit("items"), F.lit("data")), (F.col("event_id") % 4 + 1).cast("int"))
    said = F.when(F.col("event_id") % 4 == 3, F.lit('{"x": 1}')).otherwise(F.concat(F.lit('{"'), keys, F.lit('": ['), F.col("props"), F.lit("]}")))
    found = notes.first_list(said)
    return e.select("event_id", "ts", found.alias("l")).where("l IS NOT NULL").select("event_id", F.date_format("ts", "yyyy").alias("year"), F.try_variant_get(F.col("l")[0], "$.k", "int").alias("first"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, i, trim(string_split(l, ':')[1], ' ') AS key, trim(regexp_replace(l, '^[^:]*:', ''), ' ') AS value FROM l WHERE regexp_matches(l, '^[\s\x0b]*[^:]+:[\s\x0b]'))
SELECT doc_id, key, arg_max(value, i) AS value FROM e GROUP BY doc_id, key""")
def q_marker_entries(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.explode(notes.entries(F.col("text"))).alias("key", "value"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, string_agg('[' || CASE WHEN s >= 3600 THEN (s // 3600)::VARCHAR || ':' ELSE '' END || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') || '] ' || trim(l, ' '), chr(10) ORDER BY i) AS md FROM (SELECT *, (i - 1) * 7 AS s FROM l) WHERE trim(l, ' ') <> '' GROUP BY doc_id)
SELECT doc_id, coalesce(md, '(no speech)') AS md FROM documents LEFT JOIN k USING (doc_id) WHERE text IS NOT NULL""")
def q_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """The lines of every text as the segments of a recording, seven seconds each."""
    docs = load(spark, d, "documents").where("text IS NOT NULL")
    segments = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i * 7).alias("start"), x.alias("text")))
    return docs.select("doc_id", notes.transcript(segments).alias("md"))


@query(f"""SELECT CASE WHEN f = 0 AND w = 0 THEN 'all well (' || o || '/' || n || ')' ELSE array_to_string(list_filter([CASE WHEN f > 0 THEN f || ' failed' END, CASE WHEN w > 0 THEN w || ' warned' END], lambda x: x IS NOT NULL), ', ') || ' (' || o || '/' || n || ' well)' END AS headline
FROM (SELECT count(*) AS n, count(*) FILTER (status = 'ok') AS o, count(*) FILTER (status = 'fail') AS f, count(*) FILTER (status = 'warn') AS w FROM ({_ITEMS}))""")
def q_headline(spark: SparkSession, d: str) -> DataFrame:
    n = _items(spark, d).agg(F.count("*").alias("n"), *(F.count_if(F.col("status") == s).alias(s) for s in report.STATUSES))
    return n.select(report.headline(F.col("n"), F.col("ok"), F.col("fail"), F.col("warn")).alias("headline"))


@query(f"""WITH i AS (SELECT section, list({{'label': label, 'status': status, 'detail': n::VARCHAR}} ORDER BY label, status, n::VARCHAR) AS items FROM ({_ITEMS}) GROUP BY section),
c AS (SELECT count(*) FILTER (status = 'ok') AS o, count(*) FILTER (status = 'warn') AS w, count(*) FILTER (status = 'fail') AS f FROM ({_ITEMS}))
SELECT to_json({{'host': 'here', 'checkedAt': '{NOW}', 'ok': w = 0 AND f = 0, 'passed': o, 'warned': w, 'failed': f, 'sections': (SELECT list({{'key': section, 'items': items}} ORDER BY section) FROM i)}})::VARCHAR AS summary FROM c""")
def q_summary_json(spark: SparkSession, d: str) -> DataFrame:
    return report.summary_json(_items(spark, d).withColumn("detail", F.col("n").cast("string")), "here", NOW)


@query("""SELECT count(*) FILTER (event_type = 'signup') AS refined, count(*) FILTER (event_type = 'purchase') AS taken_up, count(*) FILTER (event_type = 'error') AS failed, CASE WHEN count(*) > 20 THEN 'warn' ELSE 'ok' END AS backlog FROM events""")
def q_activity(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    counted = report.activity(e, {"refined": "event_type = 'signup'", "taken_up": "event_type = 'purchase'", "failed": "event_type = 'error'", "n": "true"})
    return counted.select("refined", "taken_up", "failed", report.backlog_status(F.col("n")).alias("backlog"))


@query()
def q_yaml_values(spark: SparkSession, d: str) -> DataFrame:
    return notes.yaml_values(load(spark, d, "documents").where("text IS NOT NULL"), "doc_id", "text")


@query("""WITH k AS (SELECT tid, unnest(map_entries(actions)) AS e FROM capture_state), m AS (SELECT tid, e.key AS action, min(e.value) AS id FROM k GROUP BY ALL) SELECT tid, action, CASE WHEN action = 'task' THEN 'new' ELSE id END AS id FROM m""")
def q_merged_actions(spark: SparkSession, d: str) -> DataFrame:
    kept = load(spark, d, "capture_state").select("tid", F.explode("actions").alias("action", "id")).groupBy("tid", "action").agg(F.min("id").alias("id"))
    maps = kept.groupBy("tid").agg(F.map_from_entries(F.collect_list(F.struct("action", "id"))).alias("m"))
    new = F.when(F.map_contains_key("m", "task"), F.create_map(F.lit("task"), F.lit("new")))
    return maps.select("tid", F.explode(gates.merged_actions(F.col("m"), new)).alias("action", "id"))


@query("SELECT DISTINCT source FROM parse_error WHERE source IS NOT NULL")
def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Each source's first failure, through a stream that runs over all that is there."""
    import uuid

    from inkmill.plans.session import shared_folder
    from inkmill.streaming import flows

    at = f"{shared_folder(spark)}/inkmill/stream-{uuid.uuid4().hex}"
    table = load(spark, d, "parse_error")
    stream = spark.readStream.schema(table.schema).parquet(f"{d}/parse_error.parque[t]")  # a pattern fits a file as well as a folder
    flows.drained(flows.once(stream.where("source IS NOT NULL").select("source"), ["source"]), f"{at}/state", lambda b, n: b.write.mode("append").parquet(f"{at}/out"))
    return spark.read.parquet(f"{at}/out")


from inkmill.plans import file_queries, note_queries  # noqa: E402, F401  (they register themselves)
