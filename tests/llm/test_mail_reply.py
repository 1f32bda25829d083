import base64
import json

import numpy as np

from inkmill.llm import boosting, mail, reply


def coded(text, strip=True):
    raw = base64.urlsafe_b64encode(text if isinstance(text, bytes) else text.encode()).decode()
    return raw.rstrip("=") if strip else raw


def part(kind, text=None, parts=None, **k):
    return {"mimeType": kind, "body": {"data": coded(text)} if text is not None else {}, "parts": parts or [], **k}


def test_which_part_is_the_body():
    tree = part("multipart/mixed", parts=[part("text/html", "<p>html</p>"), part("text/plain", "  \n"), part("multipart/x", parts=[part("text/plain", "first\r\nline")]), part("text/plain", "second")], headers=[{"name": "FROM", "value": "A"}, {"name": "from", "value": '"B C" <B@x.y>'}])
    text, marks, heads = mail.body(json.dumps(tree))
    assert text == "first\nline" and marks is None and mail.person(heads["from"]) == ("B C", "b@x.y")
    assert mail.body(json.dumps(part("application/pdf"))) is None and mail.body("{") is None and mail.body(None) is None and mail.body("[]") is None
    assert mail.body(json.dumps(part("text/plain", b"a\xffb")))[0] == "a�b"


def test_html_without_tags_but_with_its_marks():
    text, marks = mail.from_html("<html><style>x</style><p>a &lt;b&gt;<br>c</p><blockquote type=cite>q<div>r</div></blockquote><div class='gmail_signature'>s</div><small>t</small></html>")
    lines = dict(zip(text.split("\n"), marks, strict=True))
    assert text.replace("\n\n", "\n").split("\n") == ["a <b>", "c", "q", "r", "s", "t"]
    assert (lines["c"], lines["q"], lines["r"], lines["s"], lines["t"]) == (0, 1, 1, 2, 4)


def test_messages_count_once(spark):
    schema = "tid string, messages array<struct<id string, internalDate string, snippet string, payload string>>, label string"
    m = ("1", "5", "s", json.dumps(part("text/plain", "hi")))
    rows = [("t", [m, m, ("2", None, None, None), (None, "1", "s", m[3])], "l"), ("t", [m, ("3", "x", "s", m[3])], None), ("u", None, None), ("v", [], None)]
    got = {r["msg_id"]: r["sent"] for r in mail.bodies(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"1": 5, "3": None}


BODY = """Hi Ann,

we keep the > sign inline. From: the desk we got nothing yet.

$ run it
> output
> done

Cheers,
Bob Stone
Lab Lead, Some Trust
Tel 030/23125422

Please consider the trees before printing this mail.

On Mon, 02 Jun 2025 at 10:00, Ann <a@x.example> wrote:
> old text
>
> Cal Reed
> Lab Lead, Other Trust"""


def test_blocks_and_what_their_marks_teach():
    found = reply.blocks(BODY, None)
    kinds = {b.text.split("\n")[0]: reply.CLASSES[k] for b, k in zip(found, reply.taught(found), strict=True)}
    assert kinds["$ run it"] == kinds["we keep the > sign inline. From: the desk we got nothing yet."] == "new" and kinds["old text"] == "quote"
    assert kinds["Cheers,"] == "new" and kinds["Please consider the trees before printing this mail."] == "new"  # nothing marks them
    text, marks = mail.from_html("<div>new</div><div class=gmail_signature>Bob Stone<br>Lab Lead, Some Trust</div><small>The views are those of the author.</small><blockquote>old</blockquote>")
    assert reply.taught(reply.blocks(text, marks)).tolist() == [reply.NEW, reply.SIGNATURE, reply.DISCLAIMER, reply.QUOTE]
    x = reply.features(reply.blocks(text, marks), "Bob Stone", "bob@x")
    assert x[:, reply.FEATURES.index("depth")].tolist() == [0, 0, 0, 1] and x[1, reply.FEATURES.index("own_name")] == 1
    below = reply.blocks("new\n\n-----Original Message-----\nFrom: X\n\nanything", None)
    assert [b.after for b in below] == [False, True, True]
    wrapped = reply.blocks("On Mon, 02 Jun 2025 at 10:00 Ann\n<a@x.example> wrote:\n\n> q\n\nmine", None)
    assert [(b.header, b.depth, b.after) for b in wrapped] == [(True, 0, False), (False, 1, False), (False, 0, False)]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5)).astype(np.float32)
    y = (x[:, 0] > 0.5).astype(int) + 2 * (x[:, 3] > 0.3)
    model = boosting.fit(x[:2000], y[:2000], 4, rounds=20)
    assert (model.classify(x[2000:]) == y[2000:]).mean() > 0.97 and len(model.classify(x[:0])) == 0


def test_quoted_blocks_are_earlier_copies_too(spark):
    rows = [("t", "m1", 1, "a@x.example", "I agree.\n\n> The bridge is shut on Monday.", None), ("t", "m2", 2, "b@x.example", "See below.\n\nThe bridge is shut on Monday.", None), ("u", "m3", 3, "b@x.example", "The bridge is shut on Monday.", None)]
    df = spark.createDataFrame([(*r[:4], "", *r[4:]) for r in rows], "tid string, msg_id string, sent bigint, address string, sender string, body string, marks array<int>")
    got = {(r["msg_id"], e["block"], e["scope"]): e["v"] for r in reply.corpus_stats(reply.cut(df)).collect() for e in r["stats"]}
    assert {k[:2]: v for k, v in got.items() if k[2] == 0} == {("m1", 0): 0.0, ("m2", 0): 0.0, ("m2", 1): 1.0, ("m3", 0): 0.0}
    assert got["m1", 0, 1] == 0.0 and got["m2", 0, 1] == 0.0 and round(got["m2", 1, 1], 3) == 0.693


def test_new_text_of_messages(spark):
    rows = []
    for i in range(60):
        m = [(f"a{i}", "1", "s", json.dumps(part("text/plain", f"Question {i} about things.\n\nDoes it work so far?", headers=[{"name": "From", "value": "Ann <a@x.example>"}]))), (f"b{i}", "2", "s", json.dumps(part("text/plain", BODY.replace("inline", f"inline {i}"), headers=[{"name": "From", "value": "Bob Stone <bob@x.example>"}])))]
        page = f"<div>Answer {i} to the question.</div><div>More is to come.</div>" + ("<div class=gmail_signature>" if i % 3 else "<div>") + "Bob Stone<br>Lab Lead, Some Trust<br>Tel 030/23125422</div>" + ("<small>" if i % 4 else "<p>") + "Please consider the trees before printing this mail."
        m.append((f"c{i}", "3", "s", json.dumps(part("text/html", page, headers=[{"name": "From", "value": "Bob Stone <bob@x.example>"}]))))
        rows.append((f"t{i}", m, None))
    rows.append(("e", [("e", None, "s", json.dumps(part("text/plain", "On Mon, 02 Jun 2025 at 10:00, Ann <a@x.example> wrote:\n> all quoted")))], None))
    df = spark.createDataFrame(rows, "tid string, messages array<struct<id string, internalDate string, snippet string, payload string>>, label string")
    got = {r["msg_id"]: r for r in reply.classified(mail.bodies(df)).collect()}
    assert got["a7"]["kinds"] == [] and got["a7"]["new_text"].endswith("so far?")
    assert got["b7"]["kinds"] == ["quote", "signature", "disclaimer"] and "> output" in got["b7"]["new_text"] and "old text" not in got["b7"]["new_text"] and "Stone" not in got["b7"]["new_text"]
    assert all(got[f"c{i}"]["kinds"] == ["signature", "disclaimer"] and got[f"c{i}"]["new_text"] == f"Answer {i} to the question.\n\nMore is to come." for i in range(60))  # marked or not
    assert got["e"]["new_text"] == "" and got["e"]["kinds"] == ["quote"]
    assert reply.classified(mail.bodies(df.limit(0))).count() == 0
