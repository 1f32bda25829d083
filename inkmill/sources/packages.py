"""Zipped document packages: their XML parts as rows, their text as markdown, and packages written back."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

SECTION = re.compile(r"Contents/section\d+\.xml$")


def parts(data: bytes) -> Iterator[tuple[int, str, int, bytes]]:
    """(number, name, compression, content) of the entries of a package, in their order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for n, info in enumerate(z.infolist()):
            yield n, info.filename, info.compress_type, z.read(info)


def rewritten(data: bytes, changed: dict[str, bytes]) -> bytes:
    """The package with the contents of some entries changed; order, names and compression stay."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as z, zipfile.ZipFile(out, "w") as target:
        for info in z.infolist():
            target.writestr(info, changed.get(info.filename, z.read(info)), compress_type=info.compress_type)
    return out.getvalue()


@dataclass
class _Open:
    """An element that is being read: what its inner elements have come to so far."""

    kind: str
    done: list[str] = field(default_factory=list)  # paragraphs and tables, rows of a table, cells of a row
    said: str = ""
    spans: str = ""
    tables: int = 0


#: Elements that gather what is inside them; all others hand it on to the one around them.
GATHER = frozenset(("p", "tbl", "tr", "tc"))


def section_text(xml: bytes) -> str:
    """Paragraphs and tables of a section in order, by one pass over its parse events.

    Of a paragraph that holds a table only the table comes out. A cell's paragraphs are escaped and parted by line breaks."""
    top = _Open("section")
    path: list[str] = []
    open_: list[_Open] = [top]
    for event, node in ElementTree.iterparse(io.BytesIO(xml), events=("start", "end")):
        name = node.tag.rpartition("}")[2]
        if event == "start":
            path.append(name)
            if name in GATHER:
                open_.append(_Open(name))
            continue
        path.pop()
        now = open_[-1]
        if name == "t" and "t" not in path:
            now.said += "".join(node.itertext())
        elif name == "cellSpan" and now.kind == "tc":
            now.spans = "".join(f' {k.lower()}="{node.get(k)}"' for k in ("colSpan", "rowSpan") if node.get(k, "1") != "1")
        elif name in GATHER:
            open_.pop()
            around = open_[-1]
            if name == "p":
                around.done += now.done if now.tables else [html.escape(now.said, quote=False) if path[-1:] == ["subList"] else now.said]
            elif name == "tc":
                around.done.append(f"<td{now.spans}>{'<br>'.join(filter(None, now.done))}</td>")
            elif name == "tr":
                around.done.append(f"<tr>{''.join(now.done)}</tr>")
            else:
                around.done.append(f"<table>{''.join(now.done)}</table>")
            around.tables += now.tables + (name == "tbl")
    return "\n\n".join(x.strip() for x in top.done if x.strip())


def package_text(data: bytes) -> str:
    """The markdown of a package: its sections in the lexical order of their names, blank lines single."""
    found = sorted((name, content) for _, name, _, content in parts(data) if SECTION.search(name))
    text = "\n\n".join(section_text(content) for _, content in found)
    return re.sub(r"\n{3,}", "\n\n", text).strip()
