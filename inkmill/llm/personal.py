"""Personal information in free text: found, judged by what it discloses, and replaced by typed placeholders.

E-mail and postal addresses, phone and identity numbers have forms of their own and disclose a person by
themselves. A name has no form: two capitalised words may as well be a town or an office. So every pair of adjacent words
that could be a name is a candidate, also inside longer runs of such words and over line ends, and the corpus tells which words reveal persons. A candidate is cued where something
beside it speaks of a person: a header, a title, a signature, an e-mail address or a phone number in the same row. For
each word the pointwise mutual information between the word and a cue is estimated over all texts; candidates whose
words exceed the threshold are names everywhere, also where nothing beside them says so.

Defined results: null and empty texts hold nothing; a value that stands several times in a text is one row; where
two kinds overlap the first of email, id, phone, address, name holds; texts given twice count once in results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.session import written
from inkmill.plans.skew import join_counted

#: Bits of mutual information with a personal cue from which a word is taken to reveal a person.
DISCLOSURE_BITS = 0.5
#: Cued and uncued sightings that every word starts with.
PRIOR = 2.0
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}

_AT = r"(?:@|＠|[ \t]?(?:\(at\)|\[at\]|\{at\}|<at>|\(골뱅이\)|\[골뱅이\])[ \t]?)"
_DOT = r"(?:[.．]|[ \t]?(?:\[dot\]|\(dot\)|\{dot\}|\[점\]|\(점\))[ \t]?)"
EMAIL = re.compile(rf"(?<![\w.+\-@/])[A-Za-z0-9](?:[\w+\-]|{_DOT}(?=\w))*{_AT}(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?{_DOT})+[A-Za-z]{{2,24}}(?![\w@])", re.I)
ID = re.compile(r"(?<![\w\-.])(?:\d{6} ?[-–] ?[1-8]\d{6}|\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d{7}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D])(?![\w\-]|\.\d)")
PHONE = re.compile(
    r"(?<![\w+./\-(])(?:"
    r"(?:\+|00)[1-9]\d{0,2}[ .\-/]?(?:\(\d{1,4}\)|\d{1,5})(?:[ .\-/]?\d{2,8}){1,4}"
    r"|\(0?\d{2,4}\) ?\d{3,5}[ .\-]\d{3,4}"
    r"|0\d{1,3}(?P<s>[\-. ])\d{3,4}(?P=s)\d{4}"
    r"|0\d{2,4}[/ ]\d{4,6}-?\d{2,4}"
    r"|01[016-9]\d{7,8}"
    r"|[2-9]\d{2}(?P<u>[\-.])\d{3}(?P=u)\d{4}"
    r")(?![\w\-/]|\.\d)"
)
_TOWN = r"[A-ZÄÖÜ][\wäöüß]+(?:-(?:[A-ZÄÖÜ]|on-|am-|an-|im-)[\wäöüß]*)*"
ADDRESS = re.compile(
    r"(?<![\w\-])(?:"
    rf"(?:(?:Flat|Unit|Suite|Apt\.?|Apartment) \d+\w?,\s)?\d{{1,4}}[a-zA-Z]?\s(?:[A-Z][\w'’\-]+\s){{1,3}}(?:Street|Avenue|Lane|Court|Square|Road|Drive|Way|Place|Terrace|Close|Crescent|Gardens|Row|Hill|Walk|Boulevard|St\.|Ave\.|Rd\.),\s{_TOWN}(?:\s\d{{4,6}}(?!\d))?"
    rf"|[A-ZÄÖÜ][\wäöüß\-]*(?:straße|strasse|str\.|gasse|weg|platz|allee|ufer|damm|ring)\s\d{{1,4}}[a-z]?,\s\d{{4,5}}\s{_TOWN}"
    r"|(?:[가-힣]{1,6}(?:특별시|광역시|도|시|군)\s)(?:[가-힣]{1,6}(?:시|군|구|읍|면|동)\s){0,3}[가-힣0-9]{1,8}(?:대로|로|길)\s?\d{1,4}(?:-\d{1,4})?(?:,?\s\d{1,4}(?:동|층|호)){0,3}"
    r")(?![\w])"
)

_WORD = r"[A-ZÀ-Þ](?:[a-zà-ÿ'’]+|[A-ZÀ-Þ]{2,})(?:-[A-ZÀ-Þ][\wà-ÿ'’]*)?"
_PLAIN = r"[A-ZÀ-Þ][a-zà-ÿ'’]+(?:-[A-ZÀ-Þ][a-zà-ÿ'’]+)?"
#: Two adjacent capitalised words of a run, a word with an initial, and a family name before a comma. They are looked ahead for, so that every
#: window of a run is seen, also the one over a line end where a name wraps.
PAIR = re.compile(rf"(?<![\w\-@./'’])(?=(?P<pair>{_PLAIN}(?:[ ]|\n){_PLAIN}|(?P<ini>[A-Z]\. ?{_PLAIN})|(?P<fam>{_WORD}),(?:[ ]|\n)(?P<giv>{_PLAIN}|[A-Z]\.))(?![\w@/\-]))")
#: The most frequent Korean family names. Fixed values.
FAMILY = "김이박최정강조윤장임한오서신권황안송전홍유고문양손배백허남심노하곽성차주우구민류나진지엄채원천방공현함변염여추도소석선설마길연위표명기반왕금옥육인맹제모"
KOREAN = re.compile(rf"(?<![가-힣\w])(?P<name>[{FAMILY}][가-힣]{{2}})(?=$|[^가-힣\w]|님[이께은의을]?|씨|드림)", re.M)
#: Words before two capitalised words that are no part of a name. Fixed values.
BEFORE = frozenset("Hi Hello Dear Thanks Thank Contact Call Ask Please From To Cc Name Dr Mr Mrs Ms Miss Prof Sir And With For By Herr Frau The Item Regards Cheers Best".split())
#: Words of mailboxes that are no persons. Fixed values.
ROLES = frozenset("digest info support team desk list noreply no-reply admin office service alerts news robot bot mailer daemon postmaster helpdesk sales billing".split())
_CUE_LEFT = re.compile(r"(?:signed by|contact person:?|ask|\bfrom:|\bto:|\bcc:|schrieb|wrote|\bdr\.?|\bmr\.?|\bmrs\.?|\bms\.?|\bprof\.?|name:|author:|by:|서명자:?|담당|담당자:?|작성자:?|이름:?|\d{1,2}:\d{2},?)\s*\*{0,2}$", re.I)
_CUE_RIGHT = re.compile(r"^\*{0,2}\s*(?:<[^>\n]{3,60}[@＠][^>\n]*>|\[mailto:|wrote:|님|씨|과장|부장|차장|대리|팀장|사원|드림|올림|:\s*$)", re.I | re.M)
_EMBEDDED = re.compile(r"data:[\w/+.\-]+;base64,[A-Za-z0-9+/=]+")


def _numbers(text: str, at: int, end: int) -> bool:
    """Whether the row of a table, or the line below a line of its own, has an address or a phone number."""
    a = text.rfind("\n", 0, at) + 1
    b = text.find("\n", end)
    b = len(text) if b < 0 else b
    line = text[a:b]
    if "|" in line and (EMAIL.search(line) or PHONE.search(line)):
        return True
    if not text[a:at].strip(" >|\t") and not text[end:b].strip():
        c = text.find("\n", b + 1)
        d = text.find("\n", c + 1) if c >= 0 else -1
        below = text[b + 1 : d if d >= 0 else min(len(text), b + 200)]
        return bool(re.search(r"^[>| \t]*[A-Z][\w ]+, [A-Z]", below) or EMAIL.search(below) or PHONE.search(below))
    return False


def _cued(text: str, at: int, end: int) -> bool:
    return bool(_CUE_LEFT.search(text[max(0, at - 24) : at])) or bool(_CUE_RIGHT.match(text[end : end + 80])) or _numbers(text, at, end)


def _free(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    return all(b <= x or a >= y for x, y in spans)


def names(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, given or whole, family, cued) of all candidates outside the taken spans."""
    for m in PAIR.finditer(text):
        a, b = m.span("pair")
        if not m["ini"] and not m["fam"]:
            given, family = re.split(r"[ \n]", m["pair"])
            if given in BEFORE:
                continue
        elif m["ini"]:
            given, family = "", m["ini"][2:].strip()
        else:
            family, given = m["fam"], m["giv"] if m["giv"][-1] != "." else ""
            if family in BEFORE or given in BEFORE:
                continue
        if given.lower() in ROLES or family.lower() in ROLES or not _free(taken, a, b):
            continue
        yield a, b, given.title() if given.isupper() else given, family.title() if family.isupper() else family, _cued(text, a, b)
    for m in KOREAN.finditer(text):
        a, b = m.span("name")
        if _free(taken, a, b):
            yield a, b, m["name"], "", _cued(text, a, b)


def mentions(text: str) -> list[tuple[str, str, int, int, str, str, bool]]:
    """(kind, found, start, end, given, family, cued) of a text; names are candidates."""
    if "base64," in text:  # embedded images say nothing, but keep their place
        text = _EMBEDDED.sub(lambda m: " " * len(m[0]), text)
    out: list[tuple[str, str, int, int, str, str, bool]] = []
    taken: list[tuple[int, int]] = []
    for kind, form in (("email", EMAIL), ("id", ID), ("phone", PHONE), ("address", ADDRESS)):
        if kind == "email" and not re.search(r"[@＠]|[(\[{<]at[)\]}>]|골뱅이", text, re.I):
            continue
        for m in form.finditer(text):
            a, b = m.span()
            if kind == "phone" and not 8 <= sum(c.isdigit() for c in m[0]) <= 16:
                continue
            if _free(taken, a, b):
                taken.append((a, b))
                out.append((kind, m[0], a, b, "", "", True))
    out += (("name", text[a:b], a, b, g, f, c) for a, b, g, f, c in names(text, taken))
    return out


SCHEMA = "origin_table string, ref_id string, kind string, found string, start int, end int, given string, family string, cued boolean"
_ARROW = pa.schema([*((c, pa.string()) for c in ("origin_table", "ref_id", "kind", "found")), ("start", pa.int32()), ("end", pa.int32()), ("given", pa.string()), ("family", pa.string()), ("cued", pa.bool_())])


def candidates(texts: DataFrame) -> DataFrame:
    """The mentions of (origin_table, ref_id, text), names still being candidates; written once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for origin, ref, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                o, r = origin.as_py(), ref.as_py()
                rows += ((o, r, *m) for m in mentions(text.as_py()))
            columns = list(zip(*rows, strict=True)) or [[] for _ in _ARROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    return written(texts.where("text IS NOT NULL AND text != ''").select("origin_table", "ref_id", "text").mapInArrow(run, SCHEMA), "mentions")


def disclosure(found: DataFrame) -> DataFrame:
    """(role, term, n, cued, bits): how much a word says that a person is spoken of."""
    pairs = found.where("kind = 'name'").groupBy("given", "family").agg(F.count("*").alias("n"), F.count_if("cued").alias("cued"))
    roles = F.explode(F.array(F.struct(F.lit("given").alias("role"), F.col("given").alias("term")), F.struct(F.lit("family").alias("role"), F.col("family").alias("term")))).alias("r")
    terms = pairs.select(roles, "n", "cued").where("r.term != ''").groupBy("r.role", "r.term").agg(F.sum("n").alias("n"), F.sum("cued").alias("cued"))
    all_ = pairs.agg(F.sum("n").alias("n"), F.sum("cued").alias("cued")).first()
    base = (all_["cued"] or 0) / max(1, all_["n"] or 0)
    share = (F.col("cued") + PRIOR * base) / (F.col("n") + PRIOR)
    return terms.withColumn("bits", F.log2(share / F.lit(max(base, 1e-9))))


def judged(found: DataFrame) -> DataFrame:
    """The mentions that disclose a person: all but names, and the names of which every word is over the threshold.

    Words are judged once for each distinct pair; the verdicts come back to the mentions by one join that keeps hot
    pairs out of the shuffle."""
    terms = disclosure(found).select("role", "term", "bits")
    pairs = found.where("kind = 'name'").groupBy("given", "family").agg(F.count("*").alias("n"))
    given = terms.where("role = 'given'").select(F.col("term").alias("given"), F.col("bits").alias("g_bits"))
    family = terms.where("role = 'family'").select(F.col("term").alias("family"), F.col("bits").alias("f_bits"))
    scored = pairs.join(given, "given", "left").join(family, "family", "left")
    bits = F.least(F.coalesce("g_bits", F.col("f_bits")), F.coalesce("f_bits", F.col("g_bits")))
    key = F.concat_ws("\x01", "given", "family")
    verdicts = written(scored.select(key.alias("pair"), "n", (bits >= DISCLOSURE_BITS).alias("reveals")), "verdicts")
    named = join_counted(found.where("kind = 'name'").withColumn("pair", key), verdicts, "pair", "n", ["reveals"]).where("reveals").drop("pair", "reveals")
    return found.where("kind != 'name'").unionByName(named)


_PART = re.compile(r"[^\W\d_][\w'’-]{2,}")


def _hidden(text: str, spans: list[dict]) -> list[tuple[int, int, str]]:
    """What is replaced in a text: the disclosed spans, and wherever else it stands each word of a name disclosed in the same text. Such a
    word was judged to reveal a person, and with the whole name beside it, it reveals this one."""
    own = sorted((s["start"], s["end"], s["kind"]) for s in spans)
    words = {w for a, b, kind in own if kind == "name" for w in _PART.findall(text[a:b])}
    lone = []
    if words:
        k = 0
        for m in re.finditer(rf"(?<![\w@.-])(?:{'|'.join(map(re.escape, sorted(words, key=len, reverse=True)))})(?![\w@-])", text):
            while k < len(own) and own[k][1] <= m.start():
                k += 1
            if k == len(own) or m.end() <= own[k][0]:
                lone.append((*m.span(), "name"))
    return sorted(own + lone)


def redact(texts: DataFrame, disclosed: DataFrame) -> DataFrame:
    """(origin_table, ref_id, text): each text once, with placeholders in the place of all that was disclosed, and of lone words of its names."""
    spans = disclosed.groupBy("origin_table", "ref_id").agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("spans"))
    once = texts.where("text IS NOT NULL").select("origin_table", "ref_id", "text").dropDuplicates(["origin_table", "ref_id"])
    arrow = pa.schema([("origin_table", pa.string()), ("ref_id", pa.string()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                parts, at = [], 0
                for start, end, kind in _hidden(text, own or []):
                    if start >= at:
                        parts += (text[at:start], PLACEHOLDERS[kind])
                    at = max(at, end)  # names of three words are two windows that overlap
                out.append("".join((*parts, text[at:])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], schema=arrow)

    return once.join(spans, ["origin_table", "ref_id"], "left").mapInArrow(run, "origin_table string, ref_id string, text string")
