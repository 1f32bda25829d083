import json

from pyspark.sql import functions as F

from inkmill.functions import text as fn
from inkmill.operators import compare, forms, gates, nested, report, search, tables, threads
from inkmill.plans.ranked import with_rank, with_sum_before
from inkmill.plans.skew import join_counted, join_salted


def one(df):
    return df.first().asDict()


# ---- nested structures


def doc(**k):
    return json.dumps({"body": {"children": []}} | k)


def test_written_tables_stay_until_they_are_released(spark):
    from inkmill.plans import session

    kept = session.written(spark.range(5).toDF("id"), "kept")
    path = kept.inputFiles()[0].removeprefix("file:").replace("///", "/")
    import os

    assert kept.count() == 5 and os.path.exists(path)
    assert session.release(spark) >= 1 and not os.path.exists(path) and session.release(spark) == 0


def test_items_keep_their_links(spark):
    whole = {"body": {"children": [{"cref": "#/texts/1"}, "#/groups/0"]}, "texts": [{"parent": {"$ref": "#/groups/9"}, "text": "a"}, {"text": "b"}, {"parent": "#/texts/0", "text": "c", "level": 2}, "odd", {"text": "lost"}], "groups": [{"label": "list", "name": "g", "children": [{"$ref": "#/tables/0"}]}], "tables": [{"data": {"table_cells": [{"start_row_offset_idx": 0, "start_col_offset_idx": 1, "text": "x", "column_header": True}]}}], "pictures": None}
    rows = [(1, json.dumps(whole)), (1, json.dumps(whole)), (2, json.dumps({"status": "ok", "document": whole})), (3, json.dumps(json.dumps(whole))), (4, json.dumps(whole)[:-3]), (5, None), (6, ""), (7, "[]"), (8, doc()), (None, doc(texts=[{"text": "n"}]))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "rec_id bigint, json_structure string, item_ref string, parent_ref string")
    got = {}
    for r in nested.flatten(df, "items").collect():
        got.setdefault(r["rec_id"], {})[r["item_ref"]] = (r["parent_ref"], r["variant"])
    expected = {"#/texts/0": ("#/groups/9", "text"), "#/texts/1": ("#/body", "text"), "#/texts/2": ("#/texts/0", "heading"), "#/texts/3": ("", "other"), "#/texts/4": ("", "text"), "#/groups/0": ("#/body", "group"), "#/tables/0": ("#/groups/0", "table")}
    assert got == {1: expected, 2: expected, 3: expected, None: {"#/texts/0": ("", "text")}}
    cell = one(nested.flatten(df, "cells").where("rec_id = 1"))
    assert (cell["row_no"], cell["col_no"], cell["row_span"], cell["is_header"], cell["text"]) == (0, 1, 1, True, "x")


def test_positions_and_pages(spark):
    s = doc(texts=[{"text": "a", "prov": [{"page_no": 2, "bbox": {"l": 1, "t": 2.5, "r": 3, "b": 4, "coord_origin": "TOP"}, "charspan": [0, 9]}, None, {"page_no": "x"}]}], pages={"1": {"size": {"width": 10, "height": 20}}, "2": {"page_no": 2}})
    df = spark.createDataFrame([(1, s)], "rec_id bigint, json_structure string")
    p = {r["pos_no"]: r for r in nested.flatten(df, "positions").collect()}
    assert p[0]["t"] == 2.5 and p[0]["char_to"] == 9 and p[2]["page_no"] is None and set(p) == {0, 2}
    assert {(r["page_no"], r["width"]) for r in nested.flatten(df, "pages").collect()} == {(1, 10.0), (2, None)}
    empty = df.limit(0)
    assert all(nested.flatten(empty, t).count() == 0 for t in nested.SCHEMAS)


# ---- comparison


def parse(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "rec_id bigint, markdown string")


def test_features_of_both_kinds_of_tables(spark):
    md = "# A\r\npara one\nstill one\n\n####### Deep\n| a | b |\n|---|:-:|\n| 1,200 | 5 % |\n\nlast\n<table><tr><td>7</td><th>x</th></tr></table>\n| no | table |"
    f = one(compare.profiles(parse(spark, md)))
    assert (f["n_tables"], f["numbers"]) == (2, ["7", "1200", "5"]) and f["headings"] == ["A", "Deep"] and f["n_paragraphs"] == 3


def test_empty_parses_agree_and_ratios_at_the_limit(spark):
    m = {r["rec_id"]: r for r in compare.metrics(parse(spark, None, "# a\n# b\n# c\n# d\n# e", "x"), parse(spark, "", "# a\n# b\n# c\n# d", "x\n\ny")).collect()}
    assert m[0]["verdict"] == "agree" and (m[0]["heading_overlap"], m[0]["paragraph_delta"], m[0]["table_match"], m[0]["numeric_match"]) == (1, 0, 1, 1)
    assert m[1]["heading_overlap"] == 0.8 and m[1]["verdict"] == "agree" and m[2]["verdict"] == "diverge"


def test_a_parse_agrees_with_itself_and_sides_swap(spark):
    a, b = (parse(spark, f"| n |\n|---|\n| {x} |\n| 2 |\n| 2 |") for x in (1, 3))
    assert one(compare.metrics(a, a))["verdict"] == "agree"
    x, y = ({(r["side"], r["value"], r["surplus"]) for r in compare.mismatches(p, q).collect()} for p, q in ((a, b), (b, a)))
    assert x == {("a_only", "1", 1), ("b_only", "3", 1)} and y == {("a_only", "3", 1), ("b_only", "1", 1)}


# ---- gates


def test_bulk_by_pages_or_by_size(spark):
    rows = [("a.pdf", 0, 99, False), ("a.pdf", 0, 100, True), ("x/Book.pdf", 0, 39, False), ("x/Book.pdf", 0, 40, True), ("a.pdf", 20 * 2**20 - 1, None, False), ("a.pdf", 20 * 2**20, None, True), ("book.pdf", 8 * 2**20, None, True), ("a.pdf", 2**40, 1, False), ("a.pdf", None, None, False)]
    df = spark.createDataFrame(rows, "path string, length bigint, pages int, want boolean")
    assert df.where(gates.bulk(F.col("path"), F.col("length"), F.col("pages"), "book") != F.col("want")).count() == 0


def test_candidates_states_and_cap(spark):
    f = spark.createDataFrame([("s/00_inbox/b.pdf", 1, 1), ("s/a.pdf", 1, 1), ("s/a.pdf", 1, 1), ("s/A.PDF", 1, 1), ("s/x_parse/a.pdf", 1, 1), ("s/00_inbox/_hold/a.pdf", 1, 1), ("s/big.pdf", 1, 500)], "path string, length bigint, pages int")
    assert [(r["path"], r["place"]) for r in gates.candidates(f, ["pdf"]).orderBy("place").collect()] == [("s/00_inbox/b.pdf", 1), ("s/a.pdf", 2), ("s/big.pdf", 3)]
    p = spark.createDataFrame([("s/a.pdf",), ("s/big.pdf",)], "path string")
    s = {r["path"]: r["state"] for r in gates.states(f, p.limit(0), p, "zz").collect()}
    assert s["s/big.pdf"] == "bulk" and s["s/a.pdf"] == "failed" and s["s/A.PDF"] == "attempt" and gates.states(f, p, p, "zz").where("state = 'done'").count() == 2
    assert {r["path"] for r in gates.admitted(f.select("path").distinct(), 1).collect()} == {"s/00_inbox/b.pdf", "s/00_inbox/_hold/a.pdf", "s/A.PDF"}


def test_ledgers_copies_and_failures(spark):
    items = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "name string, size int")
    ledger = spark.createDataFrame([("a:1",), (" ",), (None,)], "ledger_key string")
    assert {r["name"] for r in gates.not_in_ledger(items, ledger, F.concat_ws(":", "name", "size")).collect()} == {"b", None}
    docs = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, ""), (5, "")], "id int, text string")
    assert {tuple(r) for r in gates.prune_copies(docs, "id", "text").collect()} == {(2, 1), (5, 4)}
    e = spark.createDataFrame([("s", "r1", 1), ("s", "r1", 1), ("s", "r2", 1), ("t", "r", 1), ("u", None, 1)], "source string, reason string, seen_at int")
    assert {r["source"]: (r["fails"], r["reason"], r["given_up"]) for r in gates.failures(e).collect()} == {"s": (2, "r2", True), "t": (1, "r", False)}
    names = spark.createDataFrame([("1", "a.txt"), ("2", "a.txt"), ("3", "b")], "path string, name string")
    assert {r["dest"] for r in gates.unique_names(names, "name", "path").collect()} == {"a.txt", "a_1.txt", "b"}


def test_ranks_sums_and_joins_over_whole_tables(spark):
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("v"))
    assert with_rank(df, [F.desc("id")], "n").where("n != 2000 - id").count() == 0
    total = {r["id"]: r["s"] for r in with_sum_before(df, [F.asc("id")], F.col("v"), "s").collect()}
    assert total[0] == 0 and all(total[i] == sum(k % 7 for k in range(i)) for i in (1, 500, 1999))
    assert gates.within_budget(df, [F.asc("id")], F.col("v"), 10).count() == 5 and with_rank(df.limit(0), [F.asc("id")], "n").count() == 0
    left = spark.range(9000).select(F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).cast("string").alias("k"))
    table = left.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.concat(F.lit("v"), "k"))
    got = join_counted(left, table, "k", "n", ["v"])
    assert got.count() == 9000 and got.where("v != concat('v', k)").count() == 0
    salted = join_salted(left.withColumn("id", F.monotonically_increasing_id()), table.where("k != '5000'").drop("n"), "k", "id", 3)
    assert salted.count() == 8999 and salted.columns == ["k", "id", "v"]


# ---- threads


def message(i, sent, text=None, html=None, **heads):
    parts = ([{"mimeType": "text/html", "body": {"data": html}}] if html else []) + ([{"mimeType": "multipart/x", "parts": [{"mimeType": "text/plain", "body": {"data": text}}]}] if text else [])
    return (i, sent, f"snippet {i}", json.dumps({"mimeType": "multipart/mixed", "headers": [{"name": k, "value": v} for k, v in heads.items()] + [{"name": "SUBJECT", "value": f"s{i}"}], "parts": parts}))


def test_thread_documents_and_ties(spark):
    a = [message("m2", "20", text="aGkg7ZWc"), message("m1", "10", html="PGI-"), message("m3", "20"), message("m2", "20"), message("m4", None)]
    schema = "tid string, messages array<struct<id string, internalDate string, snippet string, payload string>>, label string, captured_at int"
    df = spark.createDataFrame([("t", a, "l", 2), ("t", a[:1], None, 3), ("t", a, "l", 2), ("u", [], "l", 1)], schema)
    c = threads.newest_capture(df)
    assert c.count() == 2
    i = one(threads.index(c))
    assert (i["n"], i["last_sent"], i["newest"], i["newest_last"]) == (4, 20, "m2", "m3")
    d = one(threads.documents(c))
    assert d["message_count"] == 4 and d["document"].index("snippet m4") < d["document"].index("<b>") < d["document"].index("hi 한") < d["document"].index("snippet m3") and 'subject: "sm3"\nfrom: ""\n---' in d["document"]


def test_upserts_and_actions(spark):
    found = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2), ("d", 1)], "tid string, n int")
    kept = spark.createDataFrame([("a", "f2", 2, {"task": "1"}), ("a", "f1", 2, {}), ("b", "f", 1, None), ("d", "f", None, {})], "tid string, folder string, message_count int, actions map<string,string>")
    assert {r["tid"]: (r["folder"], r["action"]) for r in threads.upserts(found, kept).collect()} == {"a": ("f1", "skip"), "b": ("f", "overwrite"), "c": (None, "new"), "d": ("f", "overwrite")}
    steps = threads.dispatch(spark.createDataFrame([("a", "x"), ("b", None), ("c", "none")], "tid string, label string"), {"x": ("reply", "task"), "none": ()})
    assert [(r["tid"], r["step"], r["action"]) for r in steps.orderBy("step").collect()] == [("a", 1, "task"), ("a", 2, "reply")]
    assert [r["action"] for r in threads.pending(steps, kept).collect()] == ["reply"]


# ---- reports, forms, tables, scalar functions


def test_reports(spark):
    items = spark.createDataFrame([("b", "x", "ok"), ("a", "y", "fail"), ("b", "w", "warn")], "g string, label string, status string")
    assert {r["no"] for r in report.numbered(items, "g", ["label"]).collect()} == {"1-1", "2-2", "2-3"}
    s = {r["g"]: (r["ok"], r["exit_code"]) for r in report.summary(items, "g").collect()}
    assert s == {"a": (False, 1), "b": (False, 2)}
    n = spark.createDataFrame([("g", f"k{i}", 1 + i % 2) for i in range(8)], "g string, k string, n int")
    assert [(r["k"], r["n"]) for r in report.top_and_rest(n, "g", "k", "n", 5).orderBy("place").collect()][-2:] == [("k0", 1), ("... 3 more", 3)]
    p = spark.createDataFrame([("abc",), ("abd",), ("zz",)], "l string")
    assert {r["plain"] for r in report.plain_labels(p, "l", {"abc": "exact"}, [("ab", "1-"), ("a", "2-")]).collect()} == {"exact", "1-d", "zz"}


def test_scalar_functions(spark):
    r = one(
        spark.range(1).select(
            fn.slug(F.lit("  Re: a/b  <c>. ")).alias("slug"), fn.slug(F.lit(" ?? ")).alias("none"), fn.slug(F.lit(None).cast("string")).alias("null"), fn.xml_escape(F.lit("<a&b>")).alias("xml"),
            fn.clock(F.lit(59.9)).alias("c1"), fn.clock(F.lit(3661)).alias("c2"), fn.column_index(F.lit("bc12")).alias("col"), fn.column_index(F.lit("12")).alias("col0"), fn.url_base64(F.lit("-_-_")).alias("b1"), fn.url_base64(F.lit("aGk")).alias("b2"), fn.url_base64(F.lit("!")).alias("b3"),
            fn.needs_review(F.lit("STATUS: ok\nx")).alias("r1"), fn.needs_review(F.lit("fine")).alias("r2"), fn.reply_subject(F.lit("RE: x")).alias("s1"), fn.reply_subject(F.lit(None).cast("string")).alias("s2"), fn.label_query(F.lit("a + b")).alias("l1"), fn.seoul(F.lit("nonsense")).alias("k"), fn.all_day_end(F.lit("2024-02-28")).alias("d1"), fn.all_day_end(F.lit("soon")).alias("d2"),
            fn.clean_controls(F.lit("a\x00b\tc\x7f﻿")).alias("clean"), fn.front_matter(F.lit('---\na: 1\nb: "x: y"\na: 2\nnone\n---\nbody')).alias("fm"), fn.front_matter(F.lit("no")).alias("fm0"), fn.extension(F.lit("d.x/a.PDF")).alias("ext"),
        )
    )
    assert r["slug"] == "Re-ab-c" and r["none"] == r["null"] == "no-subject" and r["xml"] == "&lt;a&amp;b&gt;" and (r["c1"], r["c2"]) == ("00:59", "1:01:01") and (r["col"], r["col0"]) == (54, 0)
    assert r["b2"] == "hi" and r["b1"] is not None and (r["r1"], r["r2"]) == (False, True) and (r["s1"], r["s2"]) == ("RE: x", "Re: ") and r["l1"] == "label:a-+-b" and r["k"] == "" and (r["d1"], r["d2"]) == ("2024-02-29", "soon")
    assert r["clean"] == "ab\tc" and r["fm"] == {"a": "2", "b": '"x: y"'} and r["fm0"] is None and r["ext"] == "pdf"


def test_forms(spark):
    p = '<hp:p id="1"><hp:t>{}</hp:t></hp:p>'
    xml = p.format("- {{a}}") + "<hp:tbl>" + p.format("{{b}}") + "</hp:tbl>" + p.format("x {{c}}")
    r = one(spark.createDataFrame([(xml, p.format("l1\nl2") + p.format("one"), "[L1] {{k}} [L2] {{m}} {{k}}")], "x string, m string, t string").select(forms.clean_unfilled(F.col("x")).alias("clean"), forms.split_lines(F.col("m")).alias("split"), forms.multi_line_paragraphs(F.col("m")).alias("n"), forms.fill(F.col("t"), [("{{k}}", "<{{m}}>"), ("{{m}}", "2")]).alias("filled"), forms.occurrences(F.col("t"), "{{k}}").alias("k"), forms.strip_blocks(F.lit("a<hp:linesegarray x='1'>b</hp:linesegarray>c<hp:linesegarray/>"), forms.LAYOUT).alias("s")))
    assert r["clean"] == "<hp:tbl>" + p.format("{{b}}") + "</hp:tbl>" + p.format("x {{c}}")
    assert r["split"] == p.format("l1") + p.format("l2") + p.format("one") and r["n"] == 1 and r["k"] == 2
    assert r["filled"] == "[L1] &lt;2&gt; [L2] 2 &lt;2&gt;" and (r["s"]["text"], r["s"]["n"]) == ("ac", 2)
    again = one(spark.createDataFrame([(r["clean"], r["split"])], "c string, s string").select(forms.clean_unfilled(F.col("c")).alias("c"), forms.split_lines(F.col("s")).alias("s")))
    assert again == {"c": r["clean"], "s": r["split"]}  # a second run changes nothing
    k = forms.placeholders(spark.createDataFrame([(1, "[L1] {{k}} [L2] {{m}} {{k}}")], "id int, t string"), "id", "t").orderBy("place").collect()
    assert [(x["key"], x["at"], x["label"]) for x in k] == [("k", 5, "L1"), ("m", 16, "L2")]


def test_depth_of_positions(spark):
    points = spark.createDataFrame([(1, a) for a in (0, 9, 10, 20, 24, 25, 60)] + [(2, 10)], "doc int, at int")
    spans = spark.createDataFrame([(1, 0, 50, 0), (1, 10, 30, 1), (1, 20, 25, 2), (1, 40, 40, 9)], "doc int, s int, e int, depth int")
    for width in (3, 1000):
        got = {(r["doc"], r["at"]): r["depth"] for r in forms.deepest(points, spans, "doc", width).collect()}
        assert got == {(1, 0): 0, (1, 9): 0, (1, 10): 1, (1, 20): 2, (1, 24): 2, (1, 25): 1, (1, 60): 0, (2, 10): 0}


def test_tables(spark):
    cells = spark.createDataFrame([("p", 0, 0, 0, "h|"), ("p", 0, 2, 1, "x"), ("p", 0, 2, 2, "last"), ("p", 3, 1, 3, "a\nb")], "path string, row int, col int, ord int, value string")
    rows = tables.dense_rows(cells, ["path"])
    assert {r["row"]: r["values"] for r in rows.collect()} == {0: ["h|", "", "last"], 3: ["", "a\nb"]}
    text = rows.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "values"))), lambda x: x["values"]).alias("r")).select(tables.table_text(F.col("r")).alias("t"))
    assert one(text)["t"] == "| h\\| |  | last |\n|---|---|---|\n|  | a b |  |"
    assert one(spark.range(1).select(tables.table_text(F.array(F.array(F.lit(" ")))).alias("t")))["t"] == tables.NOTHING


def test_search_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8))
    v[7] = 0
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(300)] + [(999, None)], "id bigint, v array<double>").repartition(5)
    got = {}
    for r in search.by_cosine(df, "id", "v", k=3, every=50).collect():
        got.setdefault(r["query"], {})[r["place"]] = r["hit"]
    unit = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    for q in range(0, 300, 50):
        s = np.round(unit @ unit[q], 6)
        best = sorted((i for i in range(300) if i not in (q, 7)), key=lambda i: (-s[i], i))[:3]
        assert [got[q][k] for k in (1, 2, 3)] == best
    assert search.by_cosine(df.limit(0), "id", "v").count() == 0


def test_mime_parts_of_any_depth_are_read(spark):
    import base64
    import json

    part = {"mimeType": "text/plain", "body": {"data": base64.urlsafe_b64encode("tief".encode()).decode().rstrip("=")}}
    for _ in range(12):
        part = {"mimeType": "multipart/mixed", "parts": [{"mimeType": "text/html", "body": {"data": ""}}, part]}
    df = spark.createDataFrame([(json.dumps(part),), (json.dumps({"mimeType": "text/plain", "body": {"data": "YQ"}}),), ("{", ), (None,)], "p string")
    assert [r["b"] for r in df.select(threads.plain_body(F.col("p")).alias("b")).collect()] == ["tief", "a", "", ""]


def test_search_counts_frequent_words_and_breaks_ties_by_id(spark):
    from inkmill.operators import search

    docs = spark.createDataFrame([(100, "the cat 한글 x"), (1, "the 한글"), (2, "the cat"), (3, "dog"), (4, None), (None, "the cat"), (200, ""), (5, "The, CAT!")], "id bigint, t string")
    got = [tuple(r) for r in search.by_terms(docs, "id", "t", k=2).orderBy("query", "place").collect()]
    assert got == [(100, 1, 2, 1), (100, 2, 2, 2)]
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [-1.0, 0.0])], "id bigint, v array<double>")
    assert [tuple(r) for r in search.by_cosine(v, "id", "v", k=3).orderBy("place").collect()] == [(0, 2, 1.0, 1), (0, 1, 0.0, 2), (0, 5, -1.0, 3)]
    assert search.by_terms(docs.limit(0), "id", "t").count() == search.by_cosine(v.limit(0), "id", "v").count() == 0
