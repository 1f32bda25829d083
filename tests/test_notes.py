import json

from pyspark.sql import functions as F

from inkmill.operators import forms, gates, notes, report


def one(df):
    return df.first().asDict()


def test_entries_guides_and_lists(spark):
    df = spark.createDataFrame([(1, "stage: ocr\nreason: a: b\nstage: pdf\nnone", "| `{{k}}` | x | first |\n| `{{k}}` | x | last |\n| `{{e}}` | x |  |\n| k | x | y |", '{"n": 1, "results": [{"id": 2}]}'), (2, None, None, "[3]"), (3, "", "", "{")], "id int, m string, g string, a string")
    r = {x["id"]: x for x in df.select("id", notes.entries(F.col("m")).alias("e"), F.size(notes.first_list(F.col("a"))).alias("n")).collect()}
    assert r[1]["e"] == {"stage": "pdf", "reason": "a: b"} and r[2]["e"] == r[3]["e"] == {} and (r[1]["n"], r[2]["n"]) == (1, 1) and r[3]["n"] in (-1, None)
    assert [tuple(x) for x in notes.guide(df, "id", "g").collect()] == [(1, "k", "last")]


def test_meetings_and_recordings(spark):
    n = spark.createDataFrame([("v/a.md", "---\nmeet_link: https://x/abc-defg-hij\n---"), ("v/b.md", "meet_link: abc-defg-hij"), ("v/b2.md", "meet_link: http://y/q/abc-defg-hij?x"), ("v/.hid/c.md", "meet_link: zzz-zzzz-zzz"), ("v/d.md", "x" * 3000 + "\nmeet_link: yyy-yyyy-yyy"), ("v/e.md", None)], "path string, text string")
    assert [tuple(r) for r in notes.meetings(n).collect()] == [("abc-defg-hij", "b2")]
    r = spark.createDataFrame([("abc-defg-hij (2024-05-06 10:00).mp4", "note"), ("abc-defg-hij 2024-05-06", None), ("abc-defg-hij talk.mov", "note"), ("my talk.mov", None)], "n string, t string").select(notes.recording_name(F.col("n"), F.col("t"), "rec").alias("d"))
    assert [x["d"] for x in r.collect()] == ["2024-05-06_note_rec.mp4", "2024-05-06_abc-defg-hij_rec.mp4", "abc-defg-hij_talk.mov", "my_talk.mov"]


def test_transcripts_yaml_and_tables(spark):
    s = spark.createDataFrame([(1, [(0.0, " a "), (61.5, "b"), (70.0, " ")]), (2, [(1.0, "")]), (3, [])], "id int, s array<struct<start double, text string>>")
    assert {r["id"]: r["t"] for r in s.select("id", notes.transcript(F.col("s")).alias("t")).collect()} == {1: "[00:00] a\n[01:01] b", 2: notes.NO_SPEECH, 3: notes.NO_SPEECH}
    y = spark.createDataFrame([(1, "---\na: true\nb: 2024-01-02\n---\n```yaml\nb: null\nc: 1.50\n```\n```yaml\nd: 1\n```"), (2, "---\n- x\n---"), (3, None), (4, "---\na: [\n---")], "id bigint, t string")
    assert {(r["id"], r["key"]): r["value"] for r in notes.yaml_values(y, "id", "t").collect()} == {(1, "a"): "True", (1, "b"): "", (1, "c"): "1.5"}
    md = "<table>\n<colgroup><col/></colgroup>\n<tr><td>text <b>in</b></td></tr></table>"
    r = one(spark.range(1).select(notes.clean_converted(F.lit(md)).alias("a"), notes.clean_converted(F.lit("<table><tr><td>a</td><td>b</td></tr></table>")).alias("b")))
    assert r == {"a": "text <b>in</b>", "b": "<table><tr><td>a</td><td>b</td></tr></table>"}
    t = spark.createDataFrame([("i\t2\tts\twhy",), ("j\tx",), ("alone",)], "value string")
    assert [tuple(x) for x in notes.counted_failures(t).orderBy("item").collect()] == [("i", 2, "ts", "why"), ("j", None, None, None)]


def test_done_phases_and_guards(spark):
    d = spark.createDataFrame([("a.pdf", ["docling.json"], False), ("a.pdf", ["diff.json"], True), ("a.docx", ["docling.json"], True), ("a.PNG", ["ocr.json"], True), ("a.hwp", None, False)], "path string, a array<string>, want boolean")
    assert d.where(gates.is_done(F.col("path"), F.col("a")) != F.col("want")).count() == 0
    p = spark.createDataFrame([("promote", None, None, "x"), (None, False, True, "a.mp3"), (None, False, None, "a.mp4"), (None, True, False, "x"), (None, True, True, None)], "action string, taken_up boolean, ready boolean, path string")
    assert [r["phase"] for r in gates.phases(p).collect()] == ["refine", "renew", "take_up", "none", "renew"]
    s = spark.createDataFrame([("a", "attempt"), ("b", "failed"), ("c", "done")], "path string, state string")
    assert (gates.due(s).count(), gates.due(s, True).count()) == (1, 2)
    reports, sent = spark.createDataFrame([("x",), ("y",)], "report string"), spark.createDataFrame([("x", "1"), ("y", "0")], "report string, day string")
    assert [r[0] for r in gates.unsent_today(reports, sent, "1").collect()] == ["y"] and gates.unsent_today(reports, sent, "1", True).count() == 2
    q = spark.createDataFrame([("low", False), ("low", True), (None, None)], "parse_confidence string, source_missing boolean")
    assert one(q.agg(gates.low_confidence(q).alias("c")))["c"].asDict() == {"low": 1, "missing": 1}
    assert one(q.limit(0).agg(gates.low_confidence(q).alias("c")))["c"]["low"] is None
    files = spark.createDataFrame([("v/sources/a",), ("v/sources/b",)], "path string")
    assert [r[0] for r in gates.with_counterpart(files, spark.createDataFrame([("v/knowledge/a",)], "path string")).collect()] == ["v/sources/a"]


def test_ledger_is_appended(spark, tmp_path):
    at = str(tmp_path / "ledger")
    for keys in (["a", " "], ["b"], []):
        gates.append_ledger(spark.createDataFrame([(k,) for k in keys], "ledger_key string"), at)
    assert sorted(r[0] for r in spark.read.text(at).collect()) == ["a", "b"]
    m = one(spark.range(1).select(gates.merged_actions(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3"))).alias("m"), gates.merged_actions(F.lit(None).cast("map<string,string>"), F.lit(None).cast("map<string,string>")).alias("n")))
    assert m == {"m": {"a": "1", "b": "3"}, "n": {}}


def test_templates_and_summaries(spark):
    keys = spark.createDataFrame([(1, 0, "n", 1, None), (1, 1, "o", 0, "L"), (1, 2, "p", 0, None)], "id int, place int, key string, depth int, label string")
    hints = spark.createDataFrame([(1, "p", "hint")], "id int, key string, hint string")
    assert one(forms.template_lines(keys, "id", hints))["template"] == '"o": ""  # L\n"p": ""  # hint\n"n": ""  # depth 1'
    p = '<hp:p><hp:t>{{a}}</hp:t><hp:linesegarray/></hp:p>'
    r = one(spark.range(1).select(forms.filled(F.lit(p), [("{{a}}", "1\n2")]).alias("f"), forms.missing_keys(F.lit(p), [("{{a}}", ""), ("{{b}}", "")]).alias("m")))
    assert r == {"f": "<hp:p><hp:t>1</hp:t></hp:p><hp:p><hp:t>2</hp:t></hp:p>", "m": ["{{b}}"]}
    items = spark.createDataFrame([("s", "l", "ok", None), ("s", "m", "warn", "d")], "section string, label string, status string, detail string")
    got = json.loads(one(report.summary_json(items, "h", "now"))["summary"])
    assert (got["ok"], got["passed"], got["warned"], got["sections"][0]["items"][1]["detail"]) == (False, 1, 1, "d")
    assert json.loads(one(report.summary_json(items.limit(0), "h", "now"))["summary"])["ok"] is True
    h = one(spark.range(1).select(report.headline(F.lit(3), F.lit(3), F.lit(0), F.lit(0)).alias("a"), report.headline(F.lit(3), F.lit(1), F.lit(1), F.lit(1)).alias("b"), report.counted_or_unknown(F.lit(None).cast("int"), "left").alias("c")))
    assert h == {"a": "all well (3/3)", "b": "1 failed, 1 warned (1/3 well)", "c": "left: unknown"}
