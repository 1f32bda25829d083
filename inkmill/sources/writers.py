"""Small workbooks and packages from values: what the readers read, for exports, fixtures and round trips."""

import html
import io
import struct
import zipfile

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def zipped(sheets: dict[str, str], names: list[str], shared: list[str] = ()) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {NS}><sheets>{''.join(f'<sheet name="{n}"/>' for n in names)}</sheets></workbook>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{''.join(shared)}</sst>")
        for part, rows in sheets.items():
            z.writestr(f"xl/worksheets/{part}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def record(kind: int, raw: bytes) -> bytes:
    return struct.pack("<HH", kind, len(raw)) + raw


def compound(stream: bytes, name: str = "Workbook") -> bytes:
    """A compound file of 512-byte sectors with one stream, padded beyond the size of small streams."""
    stream = stream + b"\0" * (max(4096, -(-len(stream) // 512) * 512) - len(stream))
    n = len(stream) // 512
    links = [0xFFFFFFFD, 0xFFFFFFFE] + [3 + k for k in range(n - 1)] + [0xFFFFFFFE]
    links += [0xFFFFFFFF] * (128 - len(links))
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 6
    head += struct.pack("<IIIIIIIII", 0, 1, 1, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)

    def entry(title: str, kind: int, start: int, size: int) -> bytes:
        raw = title.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw), kind, 1) + struct.pack("<III", *[0xFFFFFFFF] * 3) + b"\0" * 36 + struct.pack("<IQ", start, size)

    directory = entry("Root Entry", 5, 0xFFFFFFFE, 0) + entry(name, 2, 2, len(stream)) + b"\0" * 256
    return head + struct.pack("<128I", *links) + directory + stream


def binary_book(cells: bytes, strings: list[bytes] = (), sst_cut: int | None = None, extra: bytes = b"") -> bytes:
    """A binary workbook with one sheet named S."""
    sst = struct.pack("<II", len(strings), len(strings)) + b"".join(strings)
    shared = record(0x00FC, sst) if sst_cut is None else record(0x00FC, sst[:sst_cut]) + record(0x003C, b"\x00" + sst[sst_cut:])
    bof = record(0x0809, struct.pack("<HH", 0x0600, 5) + b"\0" * 12)

    def globals_(at: int) -> bytes:
        return bof + extra + record(0x0085, struct.pack("<IH", at, 0) + b"\x01\x00S") + shared + record(0x000A, b"")

    head = globals_(len(globals_(0)))
    return compound(head + record(0x0809, struct.pack("<HH", 0x0600, 16) + b"\0" * 12) + cells + record(0x000A, b""))


def number_record(row: int, col: int, value: float) -> bytes:
    return record(0x0203, struct.pack("<HHHd", row, col, 0, value))


def string_record(row: int, col: int, index: int) -> bytes:
    return record(0x00FD, struct.pack("<HHHI", row, col, 0, index))


def wide_string(text: str) -> bytes:
    raw = text.encode("utf-16-le")
    return struct.pack("<HB", len(raw) // 2, 1) + raw


def zipped_rows(rows: list[list], name: str) -> bytes:
    """A zipped workbook of one sheet; text goes to the shared strings, None is a gap."""
    shared: dict[str, int] = {}

    def cell(r: int, c: int, v: object) -> str:
        ref = f"{chr(65 + c)}{r + 1}"
        if isinstance(v, str):
            return f'<c r="{ref}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>'
        return f'<c r="{ref}"><v>{int(v) if v == int(v) else v!r}</v></c>'

    body = "".join(f"<row>{''.join(cell(r, c, v) for c, v in enumerate(row) if v is not None)}</row>" for r, row in enumerate(rows))
    return zipped({"sheet1": body}, [html.escape(name)], [f"<si><t>{html.escape(s)}</t></si>" for s in shared])


def binary_rows(rows: list[list], cut: int = 4000) -> bytes:
    """A binary workbook of one sheet; the shared strings go on in a continuation after ``cut`` bytes."""
    shared: dict[str, int] = {}
    cells = b""
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            if v is not None:
                cells += string_record(r, c, shared.setdefault(v, len(shared))) if isinstance(v, str) else number_record(r, c, float(v))
    strings = [wide_string(s) for s in shared]
    at = 8
    for s in strings:  # cut between two strings, where nothing is marked
        if at + len(s) > cut:
            break
        at += len(s)
    whole = struct.pack("<II", len(strings), len(strings)) + b"".join(strings)
    pieces = [whole[:at]] + [whole[k : k + 8000] for k in range(at, len(whole), 8000)] if len(whole) < 16000 else [whole]
    sst = record(0x00FC, pieces[0]) + b"".join(record(0x003C, p) for p in pieces[1:] if p)
    bof = record(0x0809, struct.pack("<HH", 0x0600, 5) + b"\0" * 12)

    def head(at: int) -> bytes:
        return bof + record(0x0085, struct.pack("<IH", at, 0) + b"\x01\x00S") + sst + record(0x000A, b"")

    return compound(head(len(head(0))) + record(0x0809, struct.pack("<HH", 0x0600, 16) + b"\0" * 12) + cells + record(0x000A, b""))


def page_rows(rows: list[list]) -> bytes:
    """A page saved as a workbook; a gap is spanned by the cell before it."""
    out = []
    for row in rows:
        cells: list[list] = []
        for v in row:
            if v is None and cells:
                cells[-1][1] += 1
            else:
                cells.append(["" if v is None else str(v), 1])
        out.append("<tr>" + "".join(f'<td colspan="{n}">{html.escape(v)}</td>' if n > 1 else f"<td>{html.escape(v)}</td>" for v, n in cells) + "</tr>")
    return f"<html><body><table>{''.join(out)}</table></body></html>".encode()


def package(paragraphs: list[str], rows: list[list[str]]) -> bytes:
    """A document package of one section: paragraphs, then a table."""

    def p(text: str) -> str:
        return f"<hp:p><hp:run><hp:t>{html.escape(text, quote=False)}</hp:t></hp:run></hp:p>"

    table = "".join("<hp:tr>" + "".join(f"<hp:tc><hp:subList>{p(c)}</hp:subList></hp:tc>" for c in row) + "</hp:tr>" for row in rows)
    section = f'<hs:sec xmlns:hs="urn:s" xmlns:hp="urn:p">{"".join(map(p, paragraphs))}<hp:p><hp:tbl>{table}</hp:tbl></hp:p></hs:sec>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/hwp+zip", compress_type=zipfile.ZIP_STORED)
        z.writestr("Contents/section0.xml", section, compress_type=zipfile.ZIP_DEFLATED)
    return out.getvalue()
