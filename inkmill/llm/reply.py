"""The text that its sender newly wrote, of each message.

A body is cut into blocks: paragraphs, cut again where the quote depth changes and at separator lines. Boosted trees
give each block one of four classes: new, quote, signature, disclaimer. Their features are those of the block itself
(quote depth, contact density, the sender's own name, legal words, place in the body) and of the corpus: whether the
block stood in an earlier message of the thread (ancestor overlap), in how many messages of the sender it stands
(sender frequency) and how many messages hold a block of the same pattern.

There are no labels for blocks, so the trees are taught by what mail programs leave in HTML messages: elements of
quotations, of signatures and of small print, besides quote prefixes and reply headers. The elements are no features:
of a block the trees see its quote depth, its form, its contact data and what the corpus says about it. Mail programs
mark only part of their signatures and notices, so an unmarked block isn't a counterexample: the share of them that is
marked is estimated on held-out messages, and a block counts as one where its probability of being marked is at least
LEAST_SHARE of it. Of some quotations the depth is hidden from the trees, where the thread still tells what they are, so
that they also learn what a quotation without marks looks like. Of plain-text
messages, which have no elements, only quotations teach; their new text, signatures and notices are all held out.

Defined results: a body without newly written text gives an empty string; shell transcripts whose lines begin with >
are no quotes; messages count once by id; a message without a time has no earlier ones and is earlier than none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm import boosting
from inkmill.plans.session import written
from inkmill.plans.skew import join_counted

#: Most messages whose blocks train the trees, those with the smallest hashed ids: HTML messages, and plain ones for their quotations.
TRAIN_MESSAGES, TRAIN_PLAIN = 3000, 1000
TREE_ROUNDS, TREE_DEPTH = 20, 3
#: A block is a signature or notice from this part on of the probability that such blocks have of being marked.
LEAST_SHARE = 0.3
#: Share of the quotations whose depth is hidden in training.
HIDDEN = 0.1
#: Distinct texts of blocks whose features a task remembers.
REMEMBERED = 50_000
CLASSES = ("new", "quote", "signature", "disclaimer")
NEW, QUOTE, SIGNATURE, DISCLAIMER = range(4)

_PREFIX = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
_BAR = re.compile(r"^\|(?: |$)")
_PROMPT = re.compile(r"^(?:\$ |[\w.@-]+[#$%] |PS .*> )")
_ATTRIBUTION = re.compile(r"^(?:On\b.{6,160}\bwrote:|.{4,120}님이 작성:|Am\b.{4,120}\bschrieb\b.{0,80}:|Le\b.{4,120}a écrit ?:|.{4,120}(?:이|가) (?:쓴 글|작성했습니다):|El\b.{4,120}escribió:)$", re.S)
_BANNER = re.compile(r"^[ \t]*-{2,} ?(?:original message|forwarded message|원본 메시지|전달된 메시지|ursprüngliche nachricht|begin forwarded message).{0,20}$|^[ \t]*begin forwarded message:", re.I)
_RULE = re.compile(r"^[_\-—=]{10,}$")
_HEAD = re.compile(r"^\*?(?:from|sent|date|to|cc|subject|von|gesendet|an|betreff|보낸 ?사람|보낸 ?날짜|받는 ?사람|제목|날짜)\*?:", re.I)
_SEPARATOR = re.compile(r"^(?:-- ?|—|_{3,}|\* ?\* ?\*|-{3,}|={3,}|~{3,})$")
_CLOSING = re.compile(r"^(?:cheers|regards|(?:best|kind|warm) (?:regards|wishes)|with best wishes|many thanks|yours (?:sincerely|faithfully|truly)|sincerely|best|mit freundlichen grüßen|viele grüße)[,.!]?$", re.I)
_DEVICE = re.compile(r"^(?:sent from (?:my|a) .{2,40}|get the .{2,30} app\b.{0,30}|get outlook for .{2,20}|von meinem .{2,30} gesendet|내 .{2,14}에서 보냄|나의 .{2,14}에서 보냄|sent (?:via|with) .{2,30})$", re.I)
_NAME = re.compile(r"^(?:[A-Z][\w'’.-]+(?: [A-Z][\w'’.-]*){1,3}|[가-힣]{2,4}(?: 드림| 올림| 배상)?)$")
_ROLE = re.compile(r"^[A-Z][\w&/ -]{2,40}, [A-Z][\w&' -]{3,60}$|^[가-힣\w ]{2,30}(?:팀|과|부|실|센터|본부|처|국)$")
_MAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_PHONE = re.compile(r"(?:(?:tel|phone|mobile|fax|[tmf])[.:]? ?|☎ ?)\+?[\d(][\d ()./-]{6,}", re.I)
_CONTACT_LINE = re.compile(r"^(?:(?:tel|phone|mobile|fax|[tmf])[.:]? ?\+?[\d(]|☎|[\w.+-]+@[\w.-]+$|https?://\S+$|(?:flat|suite|unit) \d)", re.I)
_LEGAL = re.compile(r"confidential|disclaim|unauthori[sz]ed|intended|addressee|recipient|privileg|liabilit|virus|prohibited|reserves all rights|do not bind|those of the author|before printing|registered office|company number|must not be copied|delete the message|무단|수신인|금합니다|기밀|법적 책임|삭제해 주시기|바이러스|인쇄하기 전")  # of lower-case text
_STRONG_LEGAL = re.compile(r"^(?:this e-?mail\b.{0,60}(?:attachment|meant|intended|confidential|transmission)|(?:confidentiality notice|disclaimer|legal notice|privacy notice)\b|the (?:views|information|contents?)\b.{0,60}(?:those of the author|intended|do not)|messages? (?:is|are) scanned|please consider .{2,60} before printing|본 (?:메일|이메일|전자우편)|이 (?:메일|이메일|전자우편)[은에])", re.I | re.S)


@dataclass
class Block:
    lines: list[str]  # without quote prefixes
    depth: int
    after: bool  # below a reply header
    header: bool  # is a reply header itself
    separator: bool  # begins below a signature separator
    closing: bool  # begins below a closing
    marks: int
    start: int
    end: int

    @property
    def text(self) -> str:
        return "\n".join(self.lines)


def blocks(body: str, marks: list[int] | None) -> list[Block]:
    """The blocks of a body, in order. Separator lines belong to the block below."""
    lines = body.split("\n")
    marks = list(marks) if marks is not None else [0] * len(lines)
    marks += [0] * (len(lines) - len(marks))
    out: list[Block] = []
    now: Block | None = None
    after = separator = closing = False
    prompt = False
    barred = False  # quotes drawn with bars follow their own kind of reply header
    for i, line in enumerate(lines):
        bare = line.strip()
        if not bare:
            now, prompt = None, False
            continue
        depth = 0
        if _PROMPT.match(bare):
            prompt = True
        elif (m := _PREFIX.match(line)) and not prompt:
            depth = m[1].count(">")
            line, bare = line[m.end() :], line[m.end() :].strip()
        elif barred and _BAR.match(line):
            depth = 1
            line, bare = line[1:], line[1:].strip()
        if depth == 0 and not marks[i] & 1:
            following = lines[i + 1].strip() if i + 1 < len(lines) else ""
            reply = bool(_ATTRIBUTION.match(bare)) or (bare.startswith("On ") and len(bare) < 120 and bool(_ATTRIBUTION.match(f"{bare} {following}")))
            banner = bool(_BANNER.match(bare)) or (bool(_RULE.match(bare)) and bool(_HEAD.match(following)))
            if reply or banner:
                rest = [x for x in lines[i + 1 :] if x.strip() and not _ATTRIBUTION.match(x.strip()) and not x.strip().endswith("wrote:")][:1]
                barred = barred or bool(rest and _BAR.match(rest[0]))
                if banner or not (rest and (_PREFIX.match(rest[0]) or _BAR.match(rest[0]))):
                    after = True
                now = Block([bare], 0, after, True, False, False, marks[i], i, i + 1)
                out.append(now)
                continue
            if now is not None and now.header and now.depth == 0 and (bare.endswith("wrote:") or _HEAD.match(bare)):
                now.lines.append(bare)
                now.end = i + 1
                continue
            if _SEPARATOR.match(bare):
                separator, now = True, None
                continue
            if _CLOSING.match(bare):
                closing, now = True, None
        flags = marks[i]
        if now is None or now.depth != depth or now.header or now.marks != flags:
            now = Block([], depth, after, False, separator, closing, flags, i, i)
            out.append(now)
            if depth == 0 and not _CLOSING.match(bare):
                separator = closing = False
        now.lines.append(bare)
        now.end = i + 1
    return out


def own_name(line: str, sender: str, address: str) -> bool:
    """Whether a line names the sender: by the display name, or by parts of the address."""
    words = [w.lower() for w in re.findall(r"[^\W\d_]{2,}", line)]
    if not words:
        return False
    if sender and line.lower().startswith(sender.lower()):
        return True
    local = re.sub(r"[^\w]", "", address.split("@")[0])
    return any(len(w) > 3 and w in local for w in words)


FEATURES = ("depth", "header", "lines", "words", "contact", "name", "own_name", "role", "device", "legal", "strong_legal", "greeting", "from_end", "from_start", "below_sign", "closing_line", "sentence", "closing", "ancestor", "sender_count", "pattern_count")
_AT = {f: i for i, f in enumerate(FEATURES)}
#: The first of the features that the corpus gives; the others follow from the message alone.
_CORPUS = _AT["ancestor"]
_GREETING = re.compile(r"^(?:hi|hello|dear|안녕하세요)\b", re.I)
_SENTENCE = re.compile(r"[.!?…]$")


def _form(lines: list[str]) -> tuple:
    """What a block's text alone says: its first line, the features from lines to greeting but own_name, closing line, sentence."""
    text, n = "\n".join(lines), len(lines)
    first = next((line for line in lines if not _CLOSING.match(line)), "")
    short = n <= 8 and len(first) < 80
    named = short and bool(_NAME.match(first))
    contact = sum(bool(_CONTACT_LINE.match(line)) for line in lines) / n if short else 0.0
    role = short and any(_ROLE.match(line) for line in lines[1:])
    device = len(text) < 80 and bool(_DEVICE.match(text.strip()))
    return (
        first if short else "", min(n, 20), min(text.count(" ") + n, 200), contact, named, role, device,
        len(_LEGAL.findall(text.lower())), bool(_STRONG_LEGAL.match(text)), bool(_GREETING.match(text)), bool(_CLOSING.match(lines[0])), bool(_SENTENCE.search(first)),
    )


def features(found: list[Block], sender: str, address: str, forms: dict[str, tuple] | None = None) -> np.ndarray:
    """One row for each block, the corpus' features still 0. forms: what is remembered of texts, as quoted ones come again."""
    x = np.zeros((len(found), len(FEATURES)), np.float32)
    forms = {} if forms is None else forms
    signed = False
    for i, b in enumerate(found):
        text = b.text
        if (form := forms.get(text)) is None:
            if len(forms) >= REMEMBERED:
                forms.clear()
            form = forms[text] = _form(b.lines)
        first, lines, words, contact, name, role, device, legal, strong, greeting, closing, sentence = form
        depth = b.depth + (b.after or bool(b.marks & 1))
        x[i, :_CORPUS] = (
            depth, b.header, lines, words, contact, name, bool(first) and own_name(first, sender, address), role, device, legal, strong, greeting,
            min(len(found) - 1 - i, 20), min(i, 20), signed, closing, sentence, b.closing,
        )
        signed = signed or (not depth and (device or bool(name and (role or contact))))
    return x


def taught(found: list[Block]) -> np.ndarray:
    """Classes by what mail programs leave: quotations by prefix, header or element, signatures and notices by element."""
    return np.array([QUOTE if b.depth or b.after or b.header or b.marks & 1 else SIGNATURE if b.marks & 2 else DISCLAIMER if b.marks & 4 else NEW for b in found], np.int64)


_DIGITS, _CAPITAL = re.compile(r"\d+"), re.compile(r"\b[A-Z]\w+")


def _own_key(text: str) -> int:
    """Hash of the words of a block."""
    import xxhash

    return xxhash.xxh3_64_intdigest(" ".join(text.lower().split()).encode())


def _keys(text: str, legal: bool) -> tuple[int, int]:
    """Hashes of a block: of its words, and of its pattern without numbers, names and addresses; of a legal text its first words are the pattern."""
    import xxhash

    pattern = text if "@" not in text else _MAIL.sub("@", text)
    pattern = _CAPITAL.sub("X", _DIGITS.sub("0", pattern)).split()
    return _own_key(text), xxhash.xxh3_64_intdigest(" ".join(pattern[:6] if legal else pattern).encode())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _scoped(scope: int, key: int) -> int:
    return _signed((scope * 0x9E3779B97F4A7C15 ^ key) & 0xFFFFFFFFFFFFFFFF)


#: In the place of the number of a block that only adds to the keys.
QUOTED = -1
_CUT = "tid string, msg_id string, html boolean, at bigint, x array<float>, y array<tinyint>, texts array<string>, blocks array<int>, scopes array<tinyint>, keys array<bigint>"
_CUT_ARROW = pa.schema([("tid", pa.string()), ("msg_id", pa.string()), ("html", pa.bool_()), ("at", pa.int64()), ("x", pa.list_(pa.float32())), ("y", pa.list_(pa.int8())), ("texts", pa.list_(pa.string())), ("blocks", pa.list_(pa.int32())), ("scopes", pa.list_(pa.int8())), ("keys", pa.list_(pa.int64()))])


def cut(bodies: DataFrame) -> DataFrame:
    """One row for each message, written once: the features, classes by marks and texts of its blocks, and the keys under which the
    corpus counts them: of the words in the thread (scope 0), of the words by the sender (1), of the pattern everywhere (2).

    Quoted blocks are no words of the sender; but they count as an earlier copy in the thread."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        forms: dict[str, tuple] = {}
        for batch in batches:
            rows = []
            for tid, msg_id, sent, sender, address, text, marks in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                thread, who = (xxhash.xxh3_64_intdigest(f"{k}\0{v}".encode("utf-8", "replace")) for k, v in (("t", tid), ("s", address)))
                found = blocks(text, marks)
                x = features(found, sender or "", address or "", forms)
                keyed: list[tuple[int, int, int]] = []
                for i, b in enumerate(found):
                    if b.depth or b.after or b.header:  # a quotation by its own lines is known as one
                        keyed.append((QUOTED, 0, _scoped(thread, _own_key(b.text))))
                    else:
                        own, pattern = _keys(b.text, x[i, _AT["legal"]] > 0)
                        keyed += ((i, s, _scoped(k, h)) for s, k, h in ((0, thread, own), (1, who, own), (2, 1, pattern)))
                rows.append((tid, msg_id, marks is not None, sent, x.ravel(), taught(found), [b.text for b in found], *([k[n] for k in keyed] for n in range(3))))
            columns = list(zip(*rows, strict=True)) or [[] for _ in _CUT_ARROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CUT_ARROW, strict=True)], schema=_CUT_ARROW)

    return written(bodies.select("tid", "msg_id", "sent", "sender", "address", "body", "marks").mapInArrow(run, _CUT), "mail-blocks")


def corpus_stats(messages: DataFrame) -> DataFrame:
    """(msg_id, stats): of each block that isn't quoted by its own lines whether it stood in an earlier message of the thread (0), in how many messages
    of the sender it stands (1) and how many blocks there are of its pattern (2). One aggregation over all scopes, one join back."""
    keyed = messages.select("msg_id", "at", F.inline(F.arrays_zip("blocks", "scopes", "keys"))).toDF("msg_id", "at", "block", "scope", "key")
    counted = written(keyed.groupBy("key").agg(F.count_if(F.col("block") != QUOTED).alias("n"), F.min("at").alias("first")).where("n > 0"), "block-keys")
    back = join_counted(keyed.where(F.col("block") != QUOTED), counted, "key", "n", ["n", "first"])
    value = F.when(F.col("scope") == 0, F.coalesce(F.col("first") < F.col("at"), F.lit(False)).cast("double")).otherwise(F.log1p(F.col("n") - 1))
    return written(back.groupBy("msg_id").agg(F.collect_list(F.struct("block", "scope", value.cast("float").alias("v"))).alias("stats")), "block-stats")


def _wholes(x: pa.Array, stats: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all blocks of a batch with those of the corpus, number of blocks of each message)."""
    sizes = pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64) // len(FEATURES)
    out = np.array(x.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(-1, len(FEATURES))
    first = np.cumsum(sizes) - sizes
    told = pc.fill_null(pc.list_value_length(stats), 0).to_numpy(zero_copy_only=False)
    e = stats.flatten()
    block, scope, value = (e.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    out[np.repeat(first, told) + block, _CORPUS + scope] = value
    return out, sizes


@dataclass
class Model:
    """Trees of two halves of the messages and of all, and the shares of each class that mail programs mark."""

    trees: list[boosting.Trees]
    marked: np.ndarray

    def classify(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0, np.int64)
        p = np.mean([boosting.probabilities(t, x) for t in self.trees], axis=0)
        shares = p[:, SIGNATURE:] / self.marked[SIGNATURE:]
        y = np.where(shares.max(axis=1) >= LEAST_SHARE, SIGNATURE + shares.argmax(axis=1), NEW)
        return np.where(p[:, QUOTE] >= 0.5, QUOTE, y)


def train(xs: list[np.ndarray], ys: list[np.ndarray], seed: int = 3) -> Model | None:
    """A model of messages by their features and the classes that their marks give."""
    kept = [(x, y) for x, y in zip(xs, ys, strict=True) if len(x)]
    if not kept:
        return None
    rng = np.random.default_rng(seed)

    def fitted(own: list[tuple[np.ndarray, np.ndarray]]) -> boosting.Trees:
        x, y = (np.concatenate([m[k] for m in own]) for k in (0, 1))
        hide = (y == QUOTE) & (x[:, _AT["ancestor"]] > 0) & (rng.random(len(x)) < HIDDEN)
        bare = x[hide]
        bare[:, [_AT["depth"], _AT["header"]]] = 0
        return boosting.fit(np.concatenate([x, bare]), np.concatenate([y, y[hide]]), len(CLASSES), rounds=TREE_ROUNDS, depth=TREE_DEPTH)

    halves = [kept[::2], kept[1::2] or kept]
    trees = [fitted(h) for h in halves]
    marked = np.zeros((2, len(CLASSES)))
    for k, other in enumerate((halves[1], halves[0])):
        x, y = (np.concatenate([m[n] for m in other]) for n in (0, 1))
        p = boosting.probabilities(trees[k], x)
        marked[k] = [p[y == c, c].mean() if (y == c).any() else 1.0 for c in range(len(CLASSES))]
    return Model([*trees, fitted(kept)], np.maximum(marked.mean(axis=0), 0.05))


def classified(bodies: DataFrame) -> DataFrame:
    """(tid, msg_id, new_text, kinds): what its sender newly wrote, and the other kinds of text in the body."""
    messages = cut(bodies)
    stats = corpus_stats(messages)
    heads = messages.select("msg_id", "html")
    first = [heads.where(kind).orderBy(F.xxhash64("msg_id"), "msg_id").limit(most) for kind, most in (("html", TRAIN_MESSAGES), ("NOT html", TRAIN_PLAIN))]
    rows = messages.join(F.broadcast(first[0].unionByName(first[1]).select("msg_id")), "msg_id", "left_semi").join(stats, "msg_id", "left").select("msg_id", "html", "x", "y", "stats").toArrow()  # at most as many rows
    rows = rows.sort_by("msg_id").combine_chunks()
    xs, ys, html = [], [], rows["html"].to_pylist()
    if len(rows):
        whole, sizes = _wholes(rows["x"].combine_chunks(), rows["stats"].combine_chunks())
        xs = np.split(whole, np.cumsum(sizes)[:-1])
        ys = [np.array(y, np.int64) for y in rows["y"].to_pylist()]
    if any(html):  # of plain text only quotations are known for what they are
        used = [np.ones(len(y), bool) if h else y == QUOTE for h, y in zip(html, ys, strict=True)]
        xs, ys = [x[u] for x, u in zip(xs, used, strict=True)], [y[u] for y, u in zip(ys, used, strict=True)]
    model = train(xs, ys)
    own = bodies.sparkSession.sparkContext.broadcast(model)  # of fixed size
    schema = "tid string, msg_id string, new_text string, kinds array<string>"
    arrow = pa.schema([("tid", pa.string()), ("msg_id", pa.string()), ("new_text", pa.string()), ("kinds", pa.list_(pa.string()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, sizes = _wholes(batch.column(2), batch.column(4))
            y = own.value.classify(whole) if own.value else np.full(len(whole), NEW)
            at, rows = 0, []
            for tid, msg_id, n, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes, batch.column(3).to_pylist(), strict=True):
                kinds = y[at : at + n]
                at += n
                fresh = "\n\n".join(t for t, k in zip(said, kinds, strict=True) if k == NEW and not _CLOSING.match(t))
                rows.append((tid, msg_id, fresh, [CLASSES[k] for k in sorted({int(k) for k in kinds} - {NEW})]))
            columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return messages.select("tid", "msg_id", "x", "texts").join(stats, "msg_id", "left").select("tid", "msg_id", "x", "texts", "stats").mapInArrow(run, schema)
