"""Queries of the file readers and of forms: workbooks, packages and parts are made of table rows and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.operators import forms, tables
from inkmill.plans.queries import query
from inkmill.plans.session import load
from inkmill.sources import files, packages, writers

#: Rows of one workbook, and the rows of a sheet that are read.
BOOK, CAP = 500, 300


def _books(spark: SparkSession, d: str, make: Callable[[list[list]], bytes]) -> DataFrame:
    """Workbooks (path, content) of BOOK customers each: key, name, balance, a gap for every seventh, segment."""
    c = load(spark, d, "customer").withColumn("book", F.floor(F.col("c_custkey") / BOOK))
    row = F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    grouped = c.groupBy("book").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = [make([[r["c_custkey"], r["c_name"], None if r["c_custkey"] % 7 == 0 else r["c_acctbal"], r["c_mktsegment"]] for r in rows]) for rows in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f"book{k}" for k in b.column(0).to_pylist()]), pa.array(made, pa.binary())], names=["path", "content"])

    return grouped.mapInArrow(run, "path string, content binary")


_NUMBER = "CASE WHEN {0} = floor({0}) AND abs({0}) < 1e15 THEN {0}::BIGINT::VARCHAR ELSE round({0}, 10)::VARCHAR END"
_CELLS = f"""WITH r AS (SELECT 'book' || (c_custkey // {BOOK}) AS path, row_number() OVER (PARTITION BY c_custkey // {BOOK} ORDER BY c_custkey) - 1 AS row, * FROM customer),
v AS (SELECT path, row, unnest([0, 1, 2, 3]) AS col, unnest([c_custkey::VARCHAR, c_name, CASE WHEN c_custkey % 7 <> 0 THEN {_NUMBER.format('c_acctbal')} END, c_mktsegment]) AS value FROM r WHERE row < {CAP})
SELECT path, 'SHEET' AS sheet, row::INT AS row, col::INT AS col, value FROM v WHERE value <> ''
UNION ALL SELECT DISTINCT path, 'SHEET', {CAP}, 0, '(rows cut)' FROM r WHERE row >= {CAP}"""


def _cells(books: DataFrame) -> DataFrame:
    return files.cells(books, CAP).select("path", "sheet", "row", "col", "value")


def _zipped(rows: list[list]) -> bytes:
    return writers.zipped_rows(rows, "customers")


@query(_CELLS.replace("SHEET", "customers"))
def q_workbook_zipped(spark: SparkSession, d: str) -> DataFrame:
    """Cells of zipped workbooks, with shared strings, gaps and the cut at the cap."""
    return _cells(_books(spark, d, _zipped))


@query(_CELLS.replace("SHEET", "S"))
def q_workbook_binary(spark: SparkSession, d: str) -> DataFrame:
    """Cells of binary workbooks in compound files, whose shared strings go on in continuations."""
    return _cells(_books(spark, d, writers.binary_rows))


@query(_CELLS.replace("SHEET", "table1").replace(_NUMBER.format("c_acctbal"), "c_acctbal::VARCHAR"))
def q_workbook_page(spark: SparkSession, d: str) -> DataFrame:
    """Cells of pages saved as workbooks, where a cell spans the gap after it."""
    return _cells(_books(spark, d, writers.page_rows))


@query(f"""SELECT 'book' || (c_custkey // {BOOK}) AS path, string_agg('| ' || c_custkey || ' | ' || c_name || ' | ' || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE {_NUMBER.format('c_acctbal')} END || ' | ' || c_mktsegment || ' |' || CASE WHEN n = 0 THEN chr(10) || '|---|---|---|---|' ELSE '' END, chr(10) ORDER BY c_custkey) AS md
FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey // {BOOK} ORDER BY c_custkey) - 1 AS n FROM customer) WHERE n < {CAP} GROUP BY ALL""")
def q_workbook_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The sheets of workbooks as markdown tables: sparse cells to dense rows to text."""
    cells = files.cells(_books(spark, d, _zipped), CAP).where(F.col("row") < CAP)
    rows = tables.dense_rows(cells, ["path"]).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("row", "values"))).alias("r"))
    return rows.select("path", tables.table_text(F.col("r.values")).alias("md"))


def _broken(rows: list[list]) -> bytes:
    made = writers.zipped_rows(rows, "customers")
    return made if rows[0][0] % 1000 < BOOK else made[: len(made) // 2]


@query(f"SELECT 'book' || b AS path, b % 2 = 0 AS readable FROM (SELECT DISTINCT c_custkey // {BOOK} AS b FROM customer)")
def q_workbook_broken(spark: SparkSession, d: str) -> DataFrame:
    """Every second workbook is cut off: it gives one row with its error and doesn't end the query."""
    c = files.cells(_books(spark, d, _broken), CAP)
    return c.groupBy("path").agg(F.max(F.col("error").isNull()).alias("readable"))


# ---- packages --------------------------------------------------------------------------------------------------


def _packages(spark: SparkSession, d: str) -> DataFrame:
    """Packages (path, content) of ten suppliers each: a paragraph for each, then a table."""
    s = load(spark, d, "supplier").withColumn("doc", F.floor(F.col("s_suppkey") / 10))
    grouped = s.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("rows"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = [writers.package([r["s_name"] + " & <co>" for r in rows], [[str(r["s_suppkey"]), r["s_name"] + " & <co>"] for r in rows]) for rows in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f"doc{k}" for k in b.column(0).to_pylist()]), pa.array(made, pa.binary())], names=["path", "content"])

    return grouped.mapInArrow(run, "path string, content binary")


_TEXT = """SELECT 'doc' || (s_suppkey // 10) AS path, string_agg({0} || ' & <co>', chr(10) || chr(10) ORDER BY s_suppkey) || chr(10) || chr(10) || '<table>' || string_agg('<tr><td>' || s_suppkey || '</td><td>' || {0} || ' &amp; &lt;co&gt;</td></tr>', '' ORDER BY s_suppkey) || '</table>' AS text FROM supplier GROUP BY ALL"""


@query(_TEXT.format("s_name"))
def q_package_text(spark: SparkSession, d: str) -> DataFrame:
    return files.package_texts(_packages(spark, d)).where("error IS NULL").select("path", "text")


@query(_TEXT.format("replace(s_name, 'Supplier', 'Provider')"))
def q_package_rewritten(spark: SparkSession, d: str) -> DataFrame:
    """Packages whose section was changed and written back, read again."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = []
            for content in b.column(1).to_pylist():
                section = next(c for _, n, _, c in packages.parts(content) if packages.SECTION.search(n))
                made.append(packages.rewritten(content, {"Contents/section0.xml": section.replace(b"Supplier", b"Provider")}))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["path", "content"])

    return files.package_texts(_packages(spark, d).mapInArrow(run, "path string, content binary")).select("path", "text")


@query("SELECT 'doc' || k AS path, unnest([0, 1])::INT AS part_no, unnest(['mimetype', 'Contents/section0.xml']) AS part_name, unnest([0, 8])::INT AS compression FROM (SELECT DISTINCT s_suppkey // 10 AS k FROM supplier)")
def q_package_parts(spark: SparkSession, d: str) -> DataFrame:
    return files.package_parts(_packages(spark, d)).select("path", "part_no", "part_name", "compression")


# ---- forms -----------------------------------------------------------------------------------------------------

_P, _T = '<hp:p id="1"><hp:run><hp:t>', "</hp:t></hp:run></hp:p>"
_CACHE = '<hp:linesegarray><hp:lineseg a="1"/></hp:linesegarray>'


def _forms(spark: SparkSession, d: str) -> DataFrame:
    """A form (p_partkey, text) for each part: the name, bulleted placeholders, a table with nested keys, and a layout cache."""
    k = F.col("p_partkey")
    p = lambda *c: F.concat(F.lit(_P), *c, F.lit(_T))
    key = lambda name: F.concat(F.lit(f"{{{{{name}"), (k % 7).cast("string"), F.lit("}}"))
    table = F.concat(F.lit("<hp:tbl><hp:tc>"), p(F.lit("[Size] "), key("in")), p(key("deep")), F.lit("</hp:tc></hp:tbl>"))
    text = F.concat(p(F.col("p_name")), p(F.lit("ㅇ "), key("out")), p(F.lit("[Brand] "), F.col("p_brand"), F.lit(" "), key("mid")), F.lit(_CACHE), table, F.when(k % 3 == 0, p(key("out"))).otherwise(""))
    return load(spark, d, "part").select("p_partkey", text.alias("text"))


def _q(name: str) -> str:
    return "'{{" + name + "' || (p_partkey % 7) || '}}'"


_FORM = f"""SELECT p_partkey, p_name, p_brand, '{_P}' || p_name || '{_T}' AS a, '{_P}ㅇ ' || {_q('out')} || '{_T}' AS b, '{_P}[Brand] ' || p_brand || ' ' || {_q('mid')} || '{_T}' AS c,
'<hp:tbl><hp:tc>{_P}[Size] ' || {_q('in')} || '{_T}{_P}' || {_q('deep')} || '{_T}</hp:tc></hp:tbl>' AS t, CASE WHEN p_partkey % 3 = 0 THEN '{_P}' || {_q('out')} || '{_T}' ELSE '' END AS e FROM part"""


@query(f"SELECT p_partkey, md5(a || c || '{_CACHE}' || t) AS cleaned FROM ({_FORM})")
def q_form_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Unfilled paragraphs go, but not those inside tables."""
    return _forms(spark, d).select("p_partkey", F.md5(forms.clean_unfilled(F.col("text"))).alias("cleaned"))


@query(f"SELECT p_partkey, 1 AS n, md5(a || b || c || t || e) AS rest FROM ({_FORM})")
def q_form_layout(spark: SparkSession, d: str) -> DataFrame:
    """The layout cache stripped, and how many of its elements there were."""
    return _forms(spark, d).select("p_partkey", forms.strip_blocks(F.col("text"), forms.LAYOUT).alias("s")).select("p_partkey", F.col("s.n").alias("n"), F.md5("s.text").alias("rest"))


_KEYS = """k AS (SELECT p_partkey, unnest([0, 1, 2, 3])::INT AS place, unnest(['out', 'mid', 'in', 'deep']) || (p_partkey % 7) AS key, unnest([0, 0, 1, 1])::INT AS depth, unnest([NULL, 'Brand', 'Size', 'Size']) AS label FROM part),
g AS (SELECT p_partkey, 'mid' || (p_partkey % 7) AS key, p_type AS hint FROM part WHERE p_partkey % 2 = 0)"""


def _keys(spark: SparkSession, d: str) -> DataFrame:
    """The keys of the forms with the depth of their tables."""
    f = _forms(spark, d)
    keys = forms.placeholders(f, "p_partkey", "text")
    spans = f.select("p_partkey", (F.locate("<hp:tbl>", F.col("text")) - 1).alias("s"), (F.locate("</hp:tbl>", F.col("text")) - 1).alias("e"), F.lit(1).alias("depth"))
    deep = forms.deepest(keys.select("p_partkey", "at"), spans, "p_partkey", 256)
    return keys.join(deep, ["p_partkey", "at"])


def _hints(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").where("p_partkey % 2 = 0").select("p_partkey", F.concat(F.lit("mid"), (F.col("p_partkey") % 7).cast("string")).alias("key"), F.col("p_type").alias("hint"))


@query(f"WITH {_KEYS} SELECT p_partkey, place, key, depth, label FROM k")
def q_form_keys(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys in order, the table's depth they stand at, and the label before them."""
    return _keys(spark, d).select("p_partkey", F.dense_rank().over(Window.partitionBy("p_partkey").orderBy("place")).alias("place"), "key", "depth", "label").withColumn("place", F.col("place") - 1)


@query(f"WITH {_KEYS} SELECT k.p_partkey, count(*) AS keys, count(*) FILTER (depth = 0) AS outer, count(*) FILTER (depth > 0) AS nested, count(g.key) AS matched FROM k LEFT JOIN g ON g.p_partkey = k.p_partkey AND g.key = k.key GROUP BY ALL".replace("AS outer", 'AS "outer"'))
def q_form_counts(spark: SparkSession, d: str) -> DataFrame:
    return forms.key_counts(_keys(spark, d), "p_partkey", _hints(spark, d))


@query(f"""WITH {_KEYS} SELECT k.p_partkey, string_agg('"' || k.key || '": ""  # ' || coalesce(hint, label, 'depth ' || depth), chr(10) ORDER BY depth > 0, place) AS template FROM k LEFT JOIN g ON g.p_partkey = k.p_partkey AND g.key = k.key GROUP BY ALL""")
def q_form_template(spark: SparkSession, d: str) -> DataFrame:
    """A fill-in template: outer keys first, with the guide's hint, else the label, else the depth."""
    return forms.template_lines(_keys(spark, d), "p_partkey", _hints(spark, d))


_FILL = [("{{out0}}", "a & b"), ("{{mid0}}", "x\ny"), ("{{in0}}", "{{deep0}}"), ("{{deep0}}", "<z>"), ("{{none}}", "never")]


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN md5(a || '{_P}ㅇ a &amp; b{_T}' || '{_P}[Brand] ' || p_brand || ' x{_T}{_P}y{_T}' || '<hp:tbl><hp:tc>{_P}[Size] &lt;z&gt;{_T}{_P}&lt;z&gt;{_T}</hp:tc></hp:tbl>' || CASE WHEN p_partkey % 3 = 0 THEN '{_P}a &amp; b{_T}' ELSE '' END)
ELSE md5(a || b || c || t || e) END AS filled, CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 5 END AS missing FROM ({_FORM})""")
def q_form_filled(spark: SparkSession, d: str) -> DataFrame:
    """Filled in the order of the entries, lines split into paragraphs, the layout cache stripped; and the entries without a place."""
    return _forms(spark, d).select("p_partkey", F.md5(forms.filled(F.col("text"), _FILL)).alias("filled"), F.size(forms.missing_keys(F.col("text"), _FILL)).alias("missing"))


@query("SELECT p_partkey, (p_partkey % 3)::INT AS n FROM part")
def q_form_multiline(spark: SparkSession, d: str) -> DataFrame:
    """How many paragraphs of a form have a line break in their text."""
    k = F.col("p_partkey") % 3
    two = F.concat(F.lit(f"{_P}a\nb{_T}"))
    text = F.concat(F.lit(f"{_P}one{_T}"), F.when(k > 0, two).otherwise(""), F.when(k > 1, two).otherwise(""))
    return load(spark, d, "part").select("p_partkey", forms.multi_line_paragraphs(text).alias("n"))
