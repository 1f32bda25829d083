"""Message bodies of captured mail threads.

The body of a message is its first non-empty text/plain part in tree order, else its first text/html part without
tags and with entities resolved; line ends are equal. Bytes that are not UTF-8 become U+FFFD. Of an HTML part, each
line also keeps marks of where it stood: in a quotation (1), in a signature's element (2), in small print (4).

Defined results: messages in several captures count once, by their id; a message without an id, or with neither
part, has no row; broken payloads count as missing parts; of repeated headers the last one holds.
"""

from __future__ import annotations

import base64
import binascii
import html
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "tid string, msg_id string, sent bigint, sender string, address string, body string, marks array<int>"
_ARROW = pa.schema([("tid", pa.string()), ("msg_id", pa.string()), ("sent", pa.int64()), ("sender", pa.string()), ("address", pa.string()), ("body", pa.string()), ("marks", pa.list_(pa.int32()))])

_TAG = re.compile(r"<!--.*?-->|<(?:script|style|head)\b.*?</(?:script|style|head)\s*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>", re.S | re.I)
_BLOCKS = frozenset("p div blockquote table ul ol h1 h2 h3 h4 h5 h6 pre hr body html section article header footer".split())
_LINES = frozenset(("br", "tr", "li"))
_VOID = frozenset("br hr img input meta link area base col embed source wbr".split())
_QUOTE, _SIGN, _SMALL = 1, 2, 4
_QUOTING = re.compile(r"gmail_quote|yahoo_quoted|moz-cite|type=[\"']?cite|divRplyFwdMsg", re.I)
_SIGNING = re.compile(r"signature", re.I)
_SMALLISH = re.compile(r"font-size:\s*[1-9](?:\.\d+)?p[tx]|color:\s*gr[ae]y", re.I)


def parts(payload: object) -> Iterator[dict]:
    """All parts of a MIME tree, in tree order, however deep it is."""
    todo = [payload]
    while todo:
        part = todo.pop()
        if isinstance(part, dict):
            yield part
            inner = part.get("parts")
            todo += reversed(inner if isinstance(inner, list) else [])


def decoded(part: dict) -> str:
    """The text of a part's URL-safe base64, with or without padding; empty if there is none."""
    body = part.get("body")
    data = body.get("data") if isinstance(body, dict) else None
    if not isinstance(data, str) or not data:
        return ""
    data = data.rstrip("=")
    try:
        return base64.urlsafe_b64decode(data + "=" * (-len(data) % 4)).decode("utf-8", "replace")
    except (binascii.Error, ValueError):
        return ""


def even_lines(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n")


def from_html(source: str) -> tuple[str, list[int]]:
    """(text, marks of its lines) of an HTML part."""
    lines: list[list] = [["", 0]]
    open_tags: list[tuple[str, int]] = []
    mark = 0

    def line(blank: bool) -> None:
        if blank:
            if lines[-1][0].strip():
                lines.append(["", mark])
            if len(lines) > 1 and lines[-2][0].strip():
                lines.append(["", mark])
        else:
            lines.append(["", mark])

    def say(text: str) -> None:
        if text:
            text = html.unescape(re.sub(r"\s+", " ", text)).replace("\xa0", " ")
            if not lines[-1][0]:
                text = text.lstrip()
                lines[-1][1] = mark
            lines[-1][0] += text

    at = 0
    for m in _TAG.finditer(source):
        say(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in _BLOCKS:
            line(True)
        elif name in _LINES and not m[1]:
            line(False)
        if m[1]:
            if any(t == name for t, _ in open_tags):
                while open_tags:
                    t, before = open_tags.pop()
                    mark = before
                    if t == name:
                        break
        elif name not in _VOID and not m[3].rstrip().endswith("/"):
            open_tags.append((name, mark))
            attributes = m[3]
            if name == "blockquote" or _QUOTING.search(attributes):
                mark |= _QUOTE
            elif _SIGNING.search(attributes):
                mark |= _SIGN
            elif name == "small" or _SMALLISH.search(attributes):
                mark |= _SMALL
        lines[-1][1] = mark if not lines[-1][0] else lines[-1][1]
    say(source[at:])
    while len(lines) > 1 and not lines[-1][0].strip():
        lines.pop()
    while len(lines) > 1 and not lines[0][0].strip():
        lines.pop(0)
    return "\n".join(x[0].rstrip() for x in lines), [x[1] for x in lines]


def body(payload: str | None) -> tuple[str, list[int] | None, dict[str, str]] | None:
    """(text, marks, headers) of a payload; None if it has neither part."""
    try:
        tree = json.loads(payload or "")
    except (ValueError, RecursionError):
        return None
    page = None
    heads: dict[str, str] = {}
    for h in tree.get("headers") or [] if isinstance(tree, dict) else []:
        if isinstance(h, dict) and isinstance(h.get("name"), str):
            heads[h["name"].lower()] = str(h.get("value") or "")
    for p in parts(tree):
        kind = str(p.get("mimeType") or "").lower()
        if kind == "text/plain":
            text = even_lines(decoded(p))
            if text.strip():
                return text, None, heads
        elif kind == "text/html" and page is None:
            page = decoded(p) or None
    if page is None:
        return None
    return *from_html(even_lines(page)), heads


_FROM = re.compile(r"^\s*\"?([^\"<]*?)\"?\s*<([^>]*)>")


def person(value: str) -> tuple[str, str]:
    """(display name, address) of a From header."""
    if m := _FROM.match(value):
        return m[1].strip(), m[2].strip().lower()
    return "", value.strip().lower()


def bodies(threads: DataFrame) -> DataFrame:
    """One row for each message: its thread, time (epoch ms, may be null), sender, body and marks.

    Bodies are taken out of the payloads before the shuffle that makes a message count once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tid, msg_id, sent, payload in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (found := body(payload)) is not None:
                    name, address = person(found[2].get("from", ""))
                    rows.append((tid, msg_id, int(sent) if sent and sent.strip().lstrip("-").isdecimal() and len(sent) < 19 else None, name, address, found[0], found[1]))
            columns = list(zip(*rows, strict=True)) or [[] for _ in _ARROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    each = threads.select("tid", F.explode("messages").alias("m")).where("m.id IS NOT NULL AND m.payload IS NOT NULL")
    return each.select("tid", F.col("m.id"), F.col("m.internalDate"), F.col("m.payload")).mapInArrow(run, SCHEMA).dropDuplicates(["msg_id"])
