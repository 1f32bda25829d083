"""Repair of text from scanned pages: cut words, misread characters, running titles and page numbers.

A noisy channel: each word of the true text may be misread character by character, with confusion probabilities that
are estimated from the corpus itself; the language is a model of word and word-pair counts over all records. Distinct
words are matched once against the words of the corpus that a confusion may have turned into them. What remains
plausible is joined back to the records in which the word stands, together with the counts of the word pairs around
it, and a Viterbi search over the candidate words of each line picks the most likely reading.

Running titles are paragraphs of one line that repeat within a record or have the form of a running line; page numbers
are paragraphs of nothing but a number in one of the usual forms, or stand at the end of a running title. Words cut at a line end are joined, unless the corpus knows the word with its
hyphen better than without. Records without any noise stay as they are.

Only rows of words, counts and record ids are shuffled, and the text of the noisy records; no table of words is sent
to the driver or broadcast. Defined results: null and empty texts stay as they are and have no noise; tables, code
and comments are never changed; records delivered twice count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.session import written
from inkmill.plans.skew import join_salted

#: What is read for what: (read, true). Fixed values; their probabilities are estimated.
CONFUSIONS = (("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"), ("!", "i"), ("†", "t"), ("$", "s"), ("3", "e"), ("c", "e"), ("cl", "d"), ("rn", "m"), ("li", "h"), ("ii", "u"), ("vv", "w"), ("nn", "m"), ("l", "i"), ("i", "l"), ("|", "l"), ("€", "e"))
#: Letters that are read for digits. Fixed values.
DIGITS = str.maketrans("OoIlZSbB", "00112568")
#: Confusions of letters that are tried in one word, besides its signs and digits.
MAX_EDITS = 2
#: Confusions of any kind in one word. That a word has more is taken to be impossible by the channel.
MAX_USED = 6
#: A rarer word is a misreading of a word at least so many times as frequent.
LEAST_RATIO = 8
#: Slack over the expected number of misreadings.
SLACK = 4.0
FLUSH = 200_000

_SIGN = re.compile(r"[^a-z]")
_WORDLIKE = re.compile(r"(?=.*[a-z].*[a-z])[a-z0-9@!†$|€]{3,}$")
_TRIM = "\"'()[]{}.,;:?*_<>#“”‘’…~`"
_CUT_SIGNS = "-¬‐­‑"
_CUT_END = re.compile(rf"([^\W\d_]+)([{_CUT_SIGNS}])$")
_NUM = re.compile(r"^(?![A-Z]{2}\d{6})(?=.*\d)(?=.*[OoIlZSbB])(?:[0-9OoIlZSbB]{2,}(?:[.,][0-9OoIlZSbB]+)*|[0-9OoIlZSbB]{4}-[0-9OoIlZSbB]{2}-[0-9OoIlZSbB]{2})(?=%?$|[가-힣]+$)")
_UNITS = frozenset("flat unit suite room apt apartment gate".split())

# ---- running titles and page numbers -------------------------------------------------------------------------

_N = r"[0-9OIlZSbB]{1,4}"
_PAGE = re.compile(rf"^(?:[-—–] ?{_N} ?[-—–]|(?:page|p\.|pg\.?|seite|s\.) ?{_N}(?: ?(?:of|/|von) ?{_N})?|{_N} ?/ ?{_N}|{_N} ?쪽|[-—–]? ?[ivxlc]{{1,7}} ?[-—–]?|{_N})$", re.I)
_HAS_DIGIT = re.compile(r"\d")
_ROMAN = re.compile(r"^[-—–]? ?(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}) ?[-—–]?$")
_RUNNING_NUMBER = re.compile(rf"^(?:(?P<n>{_N})[ \t]{{2,}}\S.*|\S.*?[ \t]{{2,}}(?P<m>{_N}|[ivxlc]{{1,7}}))$")
_ENDS = re.compile(r"[.!?。:;,]$|다\.?$")
_RUNNING = re.compile(r"^(?:\S.*\S[ \t]{3,}\S.*|[^|\n]{2,80} \| [^|\n]{2,120}|[^\n]{2,80} – [^\n]{2,120}|[^\n]{2,80} / \S{5,9} \d\S{3,12} \d\S{3,6}|[^\n]{2,120}\S +\*)$")
_RUNNING_NUMBER_TAIL = re.compile(rf"(?:^{_N}[ \t]{{2,}})|(?:[ \t]{{2,}}(?:{_N}|[ivxlc]{{1,7}}))$")
_LIST = re.compile(r"^\s*(?:[-*+•]|\d{1,3}[.)])\s")
_FOLD = str.maketrans("015689@!†$|", "olsbbgaitsl")
_DROP = re.compile(r"[\d\W_]+")


def page_number(line: str) -> bool:
    """Whether a line is a page number and nothing else."""
    return bool(_PAGE.match(line)) and (bool(_HAS_DIGIT.search(line)) or bool(_ROMAN.match(line)))


def folded(line: str) -> str:
    """A key under which a running title is the same on every page: without numbers, case and confusable signs."""
    line = _RUNNING_NUMBER_TAIL.sub("", line.strip())
    words = [w for w in line.split() if not (_HAS_DIGIT.search(w) and not re.search(r"[^\W\d_]{2}", w))]
    key = _DROP.sub("", " ".join(words).lower().translate(_FOLD))
    for read, true in (("cl", "d"), ("rn", "m"), ("li", "h"), ("ii", "u"), ("vv", "w"), ("c", "e")):
        key = key.replace(read, true)
    return key.replace("i", "l")


@dataclass
class Part:
    """A paragraph, or one element of a tagged text."""

    text: str
    open: bool = True  # not a table, code or a comment
    flowing: bool = True  # its lines are one paragraph
    before: str = ""  # the opening comment or tag, for telling captions and page breaks


#: A running title is shorter than so many signs; a longer line is a paragraph, even if it stands twice.
TITLE_CHARS = 160


def furniture(parts: list[Part]) -> tuple[set[int], set[str]]:
    """Positions of the parts that are running titles or page numbers, and the kinds found."""
    single = [i for i, p in enumerate(parts) if p.open and p.flowing and "\n" not in p.text.strip() and 0 < len(p.text.strip()) < TITLE_CHARS]
    gone: set[int] = set()
    kinds: set[str] = set()
    titles: dict[str, list[int]] = {}
    for i in single:
        line = parts[i].text.strip()
        if page_number(line):
            gone.add(i)
            kinds.add("pageno")
        elif not _LIST.match(line) and not line.startswith("#"):
            key = folded(line)
            if len(key) > 1:
                titles.setdefault(key, []).append(i)
    for places in titles.values():
        line = parts[places[0]].text.strip()
        if _ENDS.search(line):
            continue
        caption = [i for i in places if parts[i].before == "image"]
        free = [i for i in places if parts[i].before != "image"]
        if not free:
            continue
        form = any(_RUNNING.match(parts[i].text.strip()) for i in free)
        if len(free) > 1 or (form and not caption):
            gone.update(free)
            kinds.add("header")
            for i in free:
                m = _RUNNING_NUMBER.match(parts[i].text.strip())
                if m and (m["n"] or (m["m"] and (_HAS_DIGIT.search(m["m"]) or _ROMAN.match(m["m"])))):
                    kinds.add("pageno")
    return gone, kinds


_FENCE = re.compile(r"^(```|~~~)")
_COMMENT = re.compile(r"^<!--\s*(.*?)\s*-->$")


def markdown_parts(text: str) -> list[Part]:
    """The paragraphs of a markdown text, with code, tables and comments as parts of their own."""
    parts: list[Part] = []
    lines: list[str] = []
    before = ""

    def close(open_: bool = True) -> None:
        nonlocal lines, before
        if lines:
            flowing = open_ and not any(_LIST.match(x) and not page_number(x.strip()) or x.startswith("#") for x in lines)
            parts.append(Part("\n".join(lines), open_, flowing, before))
            lines, before = [], ""

    fence = ""
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        bare = line.strip()
        if fence:
            lines.append(line)
            if bare.startswith(fence):
                close(False)
                fence = ""
        elif m := _FENCE.match(bare):
            close()
            fence = m[1]
            lines.append(line)
        elif m := _COMMENT.match(bare):
            close()
            lines.append(line)
            close(False)
            before = m[1]
        elif not bare:
            close()
        elif bare.startswith("|") or bare.startswith("<table") or bare == "---":
            if lines and not lines[-1].lstrip().startswith("|"):
                close()
            lines.append(line)
            if bare == "---":
                close(False)
        else:
            if lines and lines[-1].lstrip().startswith("|"):
                close(False)
            lines.append(line)
    close(not fence and not (bool(lines) and lines[-1].lstrip().startswith("|")))
    for p in parts:
        if p.text.lstrip().startswith("|"):
            p.open = p.flowing = False
    return parts


_ELEMENT = re.compile(r"<(text|list_item|section_header_level_\d|caption|title|paragraph|footnote)>((?:<loc_\d+>)*)(.*?)</\1>", re.S)


def tagged_parts(text: str) -> list[tuple[Part, int, int]]:
    """The readable elements of a tagged text with their places; page headers, footers, code and tables are left out."""
    out = []
    for m in _ELEMENT.finditer(text):
        out.append((Part(m[3], True, m[1] in ("text", "paragraph"), "image" if m[1] == "caption" else ""), m.start(), m.end()))
    return out


# ---- words ---------------------------------------------------------------------------------------------------


def cuts(parts: list[Part], gone: set[int]) -> Iterator[tuple[int, int, int, int, str, str, str]]:
    """(part, line, next part, next line, head, sign, tail) of words cut at a line end; removed parts are passed over."""
    lines = [(i, k, x.strip()) for i, p in enumerate(parts) if p.open and i not in gone for k, x in enumerate(p.text.split("\n")) if x.strip()]
    for (i, k, line), (j, n, following) in zip(lines, lines[1:], strict=False):
        m = _CUT_END.search(line)
        if m and not following.startswith("#") and not _LIST.match(following):
            tail = re.match(r"[^\W\d_]\S*", following)
            if tail and (tail[0][0].islower() or not tail[0][0].isascii()) or tail is None and m[2] != "-" and following[:1] in "01569@!†":
                yield i, k, j, n, m[1], m[2], (tail[0] if tail else following.split()[0])


def core(token: str) -> tuple[str, str, str]:
    """(left, core, right) of a token without its punctuation. A ! stays, as it may be a misread letter inside."""
    inner = token.strip(_TRIM)
    a = token.find(inner) if inner else 0
    right = token[a + len(inner) :]
    if inner.endswith("!"):
        right = "!" + right
        inner = inner[:-1]
    return token[:a], inner, right


def fixed_number(token: str, previous: str) -> str | None:
    """A number with letters read for digits, set right; None if the token is none."""
    m = _NUM.match(token)
    if not m or previous.lower().strip(_TRIM) in _UNITS:
        return None
    return m[0].translate(DIGITS) + token[m.end() :]


def readings(word: str) -> Iterator[tuple[str, tuple[int, ...]]]:
    """(true word, confusions) that may have been read as ``word``: all its signs and digits explained, and at most MAX_EDITS letters besides."""
    found: dict[str, tuple[int, ...]] = {}
    todo = [("", 0, (), 0)]
    while todo:
        done, at, used, edits = todo.pop()
        if at >= len(word):
            if used and done not in found:
                found[done] = used
            continue
        sign = bool(_SIGN.match(word[at]))
        for k, (read, true) in enumerate(CONFUSIONS):
            if word.startswith(read, at) and (sign or edits < MAX_EDITS - (1 if any(_SIGN.match(CONFUSIONS[u][0]) for u in used) else 0)) and len(used) < MAX_USED:
                todo.append((done + true, at + len(read), (*used, k), edits + (not sign)))
        if not sign:
            todo.append((done + word[at], at + 1, used, edits))
    yield from found.items()


def _hash(text: str) -> int:
    import xxhash

    v = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return v - (1 << 64) if v >= 1 << 63 else v


def _joined(parts: list[Part], gone: set[int]) -> str:
    """The open text of the parts, cut words joined, for counting."""
    text = "\n".join(p.text for i, p in enumerate(parts) if p.open and i not in gone)
    return re.sub(rf"(?<=[^\W\d_])[{_CUT_SIGNS}]\s*\n\s*(?=[^\W\d_A-Z])", "", text)


def lexical(text: str) -> list[str]:
    """The lower-case words of a text as the language model counts them."""
    return [w for t in text.lower().split() if (w := core(t)[1])]


EVIDENCE = "kind tinyint, rec_id bigint, word string, other string, key bigint, n bigint"
_EVIDENCE = pa.schema([("kind", pa.int8()), ("rec_id", pa.int64()), ("word", pa.string()), ("other", pa.string()), ("key", pa.int64()), ("n", pa.int64())])
WORD, PAIR, STANDS, COMPOUND, FORM = range(5)


def evidence(docs: DataFrame) -> DataFrame:
    """Counts of words and word pairs over all records, the words of each record that might be misread, its cut words, and whether its form has noise.

    Counts are added up within a task before they leave it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        pairs: Counter[str] = Counter()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[] for _ in _EVIDENCE]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EVIDENCE, strict=True)], schema=_EVIDENCE)

        def counted() -> pa.RecordBatch:
            rows = [(WORD, None, w, None, None, n) for w, n in words.items()] + [(PAIR, None, None, None, _hash(w), n) for w, n in pairs.items()]
            words.clear()
            pairs.clear()
            return batch_of(rows)

        for batch in batches:
            rows: list[tuple] = []
            for rec_id, markdown, tagged in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                stands: set[str] = set()
                form = False
                sources = ([markdown_parts(markdown)] if markdown else []) + ([[p for p, _, _ in tagged_parts(tagged)]] if tagged else [])
                for k, parts in enumerate(sources):
                    gone, kinds = furniture(parts)
                    broken = list(cuts(parts, gone))
                    form = form or bool(kinds) or bool(broken)
                    for *_, head, sign, tail in broken:
                        if sign == "-":
                            tail = core(tail.lower())[1]
                            rows.append((COMPOUND, rec_id, head.lower() + tail, f"{head.lower()}-{tail}", None, None))
                    said = lexical(_joined(parts, set()))
                    stands.update(said)
                    form = form or any(_NUM.match(w) for w in {core(t)[1] for p in parts if p.open for t in p.text.split() if t[:1].isdigit() or t[-1:].isdigit() or t[:1] in "OIlZSbB"})
                    if k == 0:
                        words.update(said)
                        pairs.update(map(" ".join, zip(said, said[1:], strict=False)))
                rows += ((STANDS, rec_id, None, None, _hash(w), None) for w in stands if _WORDLIKE.match(w))
                if form:
                    rows.append((FORM, rec_id, None, None, None, None))
            yield batch_of(rows)
            if len(pairs) > FLUSH:
                yield counted()
        yield counted()

    return written(docs.mapInArrow(run, EVIDENCE), "scan-evidence")


def corrections(words: DataFrame) -> DataFrame:
    """(word, key, true, cost): the plausible readings of every distinct word, with the log probability of the confusions.

    The probability of a confusion is the share of its true characters that it was found in; it is estimated from the
    readings of words that hold signs or digits, and of rare words, and then used to judge all readings."""
    schema = "word string, key bigint, n bigint, true string, used array<int>"
    arrow = pa.schema([("word", pa.string()), ("key", pa.int64()), ("n", pa.int64()), ("true", pa.string()), ("used", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, _hash(w), n, true, list(used)) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if _WORDLIKE.match(w) for true, used in readings(w)]
            columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    # frequent words are no misreadings of anything more frequent by LEAST_RATIO
    most = words.agg(F.max("n")).first()[0] or 0
    tried = words.where(F.col("n") * LEAST_RATIO <= most).select("word", "n").mapInArrow(run, schema)
    known = tried.join(words.select(F.col("word").alias("true"), F.col("n").alias("m")), "true").where(F.col("m") >= LEAST_RATIO * F.col("n"))
    known = written(known.where(~F.col("true").rlike("[^a-z]")).select("word", "key", "n", "true", "m", "used"), "scan-readings")
    letters = words.select(F.explode(F.split(F.col("word"), "")).alias("c"), "n").where("c != ''").groupBy("c").agg(F.sum("n").alias("n")).where(F.col("c").rlike("^[a-z]$"))
    of = {r["c"]: r["n"] for r in letters.collect()}  # at most 26 rows
    seen = {r["k"]: r["n"] for r in known.where("size(used) = 1").select(F.col("used")[0].alias("k"), "n").groupBy("k").agg(F.sum("n").alias("n")).collect()}  # at most as many as CONFUSIONS
    rate = [math.log((seen.get(k, 0) + 0.5) / (of.get(true, 0) + 1000.0)) for k, (_, true) in enumerate(CONFUSIONS)]
    logs = F.array(*map(F.lit, rate))
    cost = F.aggregate("used", F.lit(0.0), lambda acc, k: acc + F.element_at(logs, k + 1))
    signs = F.col("word").rlike("[^a-z]")
    judged = known.withColumn("cost", cost).where(signs | (F.col("n") <= 3 + SLACK * F.col("m") * F.exp("cost")))
    return written(judged.select("word", "key", "true", "m", "n", "cost"), "scan-corrections")


@dataclass
class Knowledge:
    """What the corpus says about the words of one record."""

    readings: dict[str, list[tuple[str, float, int]]] = field(default_factory=dict)  # word: (true, cost, count)
    compounds: frozenset[str] = frozenset()
    pairs: dict[int, int] = field(default_factory=dict)
    own: dict[str, int] = field(default_factory=dict)  # counts of the words as they stand


def viterbi(tokens: list[str], known: Knowledge) -> list[str]:
    """The most likely true words of a line of lower-case words: channel times word-pair likelihood."""
    # that a word is a true one which the corpus hardly knows is taken to be as unlikely as its likeliest misreading
    options = [[(w, max(c for _, c, _ in known.readings[w]), max(1, known.own.get(w, 1)))] + known.readings[w] if w in known.readings else [(w, 0.0, 0)] for w in tokens]
    if all(len(o) == 1 for o in options):
        return tokens
    best: list[tuple[float, int]] = [(0.0, -1)] * len(options[0])
    trace: list[list[int]] = []
    score = [c + math.log(n) if n else 0.0 for _, c, n in options[0]]
    trace.append([-1] * len(options[0]))
    for before, now in zip(options, options[1:], strict=False):
        step, back = [], []
        for w, c, n in now:
            own = c + math.log(n) if n else 0.0
            top = max(range(len(before)), key=lambda i: score[i] + math.log1p(known.pairs.get(_hash(f"{before[i][0]} {w}"), 0)))  # noqa: B023
            step.append(own + score[top] + math.log1p(known.pairs.get(_hash(f"{before[top][0]} {w}"), 0)))
            back.append(top)
        score = step
        trace.append(back)
    at = max(range(len(score)), key=lambda i: score[i])
    out = []
    for k in range(len(options) - 1, -1, -1):
        out.append(options[k][at][0])
        at = trace[k][at]
    return out[::-1]


def _cased(read: str, true: str) -> str:
    if read.isupper() and len(read) > 1:
        return true.upper()
    return true[:1].upper() + true[1:] if read[:1].isupper() else true


def reread(line: str, known: Knowledge) -> tuple[str, bool]:
    """A line with its words and numbers set right, and whether anything was misread."""
    pieces = re.split(r"(\s+)", line)
    at = [k for k in range(0, len(pieces), 2) if pieces[k]]
    cores = [core(pieces[k]) for k in at]
    true = viterbi([c[1].lower() for c in cores], known)
    changed = False
    previous = ""
    for k, (left, own, right), word in zip(at, cores, true, strict=True):
        number = fixed_number(own, previous)
        if number is not None and "@" not in pieces[k]:
            pieces[k], changed = left + number + right, True
        elif word != own.lower():
            pieces[k], changed = left + _cased(own, word) + right, True
        previous = own
    return "".join(pieces), changed


def _flow(lines: list[str]) -> str:
    """Lines as one; after a hyphen without a blank."""
    out = ""
    for line in (x.strip() for x in lines):
        if line:
            out += line if out[-1:] == "-" and out[-2:-1].isalpha() else f" {line}"
    return out.strip()


def mend(parts: list[Part], known: Knowledge) -> tuple[list[str | None], set[str]]:
    """(new texts, kinds): the parts as continuous paragraphs. None for a part that is gone or that went into the one before."""
    gone, kinds = furniture(parts)
    lines: dict[int, list[str]] = {i: p.text.split("\n") for i, p in enumerate(parts)}
    merged: dict[int, int] = {}
    for i, k, j, n, head, sign, tail in list(cuts(parts, gone)):
        whole = sign == "-" and f"{head.lower()}-{core(tail.lower())[1]}" in known.compounds
        if not whole:
            kinds.add("hyphen")
        first, second = lines[i][k].rstrip(), lines[j][n].lstrip()
        word, _, rest = second.partition(" ")
        lines[i][k] = (first if whole else first[:-1]) + word
        lines[j][n] = rest
        if i != j and parts[i].flowing and parts[j].flowing:
            merged[j] = i
    for i, p in enumerate(parts):  # title lines are read for misreadings too before they go
        if p.open:
            for k, line in enumerate(lines[i]):
                lines[i][k], changed = reread(line, known)
                if changed:
                    kinds.add("misread")
    if not kinds:
        return [p.text for p in parts], kinds
    out: list[str | None] = []
    last = -1
    for i, p in enumerate(parts):
        if i in gone:
            out.append(None)
            continue
        text = _flow(lines[i]) if p.open and p.flowing else "\n".join(x for x in lines[i] if x.strip() or not p.open)
        passed = last >= 0 and p.open and p.flowing and (i in merged or (last < i - 1 and all(k in gone or parts[k].before == "" and not parts[k].open and "page break" in parts[k].text for k in range(last + 1, i)) and parts[last].flowing and bool(out[last]) and not re.search(r"[.!?。:]['\")\]]?$", out[last]) and not text[:1].isupper()))
        if passed and out[last] is not None:
            out[last] = f"{out[last]} {text}".strip()
            out.append(None)
            continue
        out.append(text)
        if p.open and p.flowing:
            last = i
    return out, kinds


def repair_markdown(text: str | None, known: Knowledge) -> tuple[str | None, set[str]]:
    if not text:
        return text, set()
    new, kinds = mend(markdown_parts(text), known)
    return ("\n\n".join(x for x in new if x) if kinds else text), kinds


def repair_tagged(text: str | None, known: Knowledge) -> tuple[str | None, set[str]]:
    if not text:
        return text, set()
    found = tagged_parts(text)
    new, kinds = mend([p for p, _, _ in found], known)
    if not kinds:
        return text, kinds
    out, at = [], 0
    for (part, a, b), own in zip(found, new, strict=True):
        out.append(text[at:a])
        if own is not None:
            k = text.index(part.text, a) if part.text else b
            out.append(text[a:k] + own + text[k + len(part.text) : b])
        elif out[-1].endswith("\n"):
            out[-1] = out[-1][:-1]
        at = b
    return "".join([*out, text[at:]]), kinds


def repaired(docs: DataFrame, id_col: str = "rec_id", text_col: str = "markdown", tags_col: str = "doctags") -> DataFrame:
    """(rec_id, markdown, doctags, noise) of the records that have noise; all other records stay as they are."""
    docs = docs.select(docs[id_col].cast("bigint").alias("rec_id"), docs[text_col].alias("markdown"), docs[tags_col].alias("doctags")).where("rec_id IS NOT NULL AND (markdown != '' OR doctags != '')")
    seen = evidence(docs)
    words = written(seen.where(F.col("kind") == WORD).groupBy("word").agg(F.sum("n").alias("n")), "scan-words")
    fixes = corrections(words)
    stands = seen.where(F.col("kind") == STANDS).select("rec_id", "key").distinct()
    options = join_salted(stands, fixes, "key", "rec_id").groupBy("rec_id").agg(F.collect_list(F.struct("word", "true", "m", "n", "cost")).alias("options"))
    compound = seen.where(F.col("kind") == COMPOUND).select("rec_id", F.col("word").alias("whole"), F.col("other").alias("hyphened")).distinct()
    hyphened = compound.join(words.select(F.col("word").alias("hyphened"), F.col("n").alias("h")), "hyphened").join(words.select(F.col("word").alias("whole"), F.col("n").alias("w")), "whole", "left")
    compounds = hyphened.where("h >= coalesce(w, 0)").groupBy("rec_id").agg(F.collect_set("hyphened").alias("compounds"))
    form = seen.where(F.col("kind") == FORM).select("rec_id").distinct()
    marks = form.join(options, "rec_id", "full").join(compounds, "rec_id", "left")
    noisy = written(docs.join(marks, "rec_id").dropDuplicates(["rec_id"]), "scan-noisy")

    def around(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for rec_id, markdown, tagged, options in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                by: dict[str, list[str]] = {}
                for o in options or ():
                    by.setdefault(o["word"], [o["word"]]).append(o["true"])
                own: set[int] = set()
                for parts in ([markdown_parts(markdown)] if markdown else []) + ([[p for p, _, _ in tagged_parts(tagged)]] if tagged else []):
                    said = lexical(_joined(parts, set()))
                    for a, b in zip(said, said[1:], strict=False):
                        if a in by or b in by:
                            own.update(_hash(f"{x} {y}") for x in by.get(a, (a,)) for y in by.get(b, (b,)))
                ids += [rec_id] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64())], names=["rec_id", "key"])

    pairs = seen.where(F.col("kind") == PAIR).groupBy("key").agg(F.sum("n").alias("n"))
    asked = written(noisy.where("options IS NOT NULL").select("rec_id", "markdown", "doctags", "options").mapInArrow(around, "rec_id bigint, key bigint").distinct(), "scan-asked")
    told = join_salted(asked, pairs.join(asked.select("key").distinct(), "key", "left_semi"), "key", "rec_id").groupBy("rec_id").agg(F.collect_list(F.struct("key", "n")).alias("pairs"))
    arrow = pa.schema([("rec_id", pa.int64()), ("markdown", pa.string()), ("doctags", pa.string()), ("noise", pa.list_(pa.string()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rec_id, markdown, tagged, options, compounds, pairs in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                known = Knowledge(compounds=frozenset(compounds or ()), pairs={p["key"]: p["n"] for p in pairs or ()})
                for o in options or ():
                    known.readings.setdefault(o["word"], []).append((o["true"], o["cost"], o["m"]))
                    known.own[o["word"]] = o["n"] if o["word"].isalpha() else 1
                text, found = repair_markdown(markdown, known)
                tags, also = repair_tagged(tagged, known)
                if found or also:
                    rows.append((rec_id, text, tags, sorted(found | also)))
            columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return noisy.join(told, "rec_id", "left").select("rec_id", "markdown", "doctags", "options", "compounds", "pairs").mapInArrow(run, "rec_id bigint, markdown string, doctags string, noise array<string>")
