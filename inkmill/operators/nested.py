"""Deeply nested document structures as related flat tables.

A bottom-up tree automaton gives every JSON value a state from the states of its parts (TRANSITIONS). The state of
an item decides the subtype table it is routed to; the keys that all items have (record, reference, parent, array,
position, label) stay together in the common table, and every row of a subtype table keeps its record and its item.

Tables: ``items`` (the common one), ``texts``, ``cells``, ``positions``, ``pages``.
Defined results: a null, cut-off or otherwise broken structure has no rows, nor has one nested deeper than a JSON parser can go; an element that is no object is an item
of variant ``other``; a missing array is an empty one; records given several times count once; a null record id
stays null; other columns of the input are left alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Arrays of a structure that hold items.
ARRAYS = ("texts", "groups", "tables", "pictures")
#: Keys of a link object.
LINKS = ("$ref", "cref")

SCHEMAS = {
    "items": "rec_id bigint, item_ref string, parent_ref string, item_array string, item_pos int, variant string, label string, name string, n_children int",
    "texts": "rec_id bigint, item_ref string, parent_ref string, variant string, level int, enumerated boolean, text string, orig string",
    "cells": "rec_id bigint, item_ref string, cell_pos int, row_no int, col_no int, row_span int, col_span int, is_header boolean, text string",
    "positions": "rec_id bigint, item_ref string, pos_no int, page_no int, l double, t double, r double, b double, coord_origin string, char_from int, char_to int",
    "pages": "rec_id bigint, page_no int, width double, height double",
}

# ---- the automaton -------------------------------------------------------------------------------------------

#: Object states, tried in order: (state, keys that must be there, states that keys must have if they are there).
TRANSITIONS: tuple[tuple[str, frozenset[str], dict[str, frozenset[str]]], ...] = (
    ("bbox", frozenset("ltrb"), {k: frozenset({"number"}) for k in "ltrb"}),
    ("size", frozenset({"width", "height"}), {"width": frozenset({"number"}), "height": frozenset({"number"})}),
    ("position", frozenset({"page_no", "bbox"}), {"page_no": frozenset({"number"})}),
    ("page", frozenset({"page_no"}), {"page_no": frozenset({"number"})}),
    ("cell", frozenset({"start_row_offset_idx", "start_col_offset_idx"}), {}),
    ("grid", frozenset({"table_cells"}), {}),
    ("table", frozenset({"data"}), {"data": frozenset({"grid", "object"})}),
    ("document", frozenset({"body"}), {}),
    ("document", frozenset({"texts"}), {}),
    ("wrapper", frozenset({"document"}), {"document": frozenset({"document", "wrapper", "packed"})}),
    ("heading", frozenset({"text", "level"}), {"level": frozenset({"number"})}),
    ("entry", frozenset({"text", "enumerated"}), {"enumerated": frozenset({"truth"})}),
    ("text", frozenset({"text"}), {}),
    ("picture", frozenset({"captions"}), {}),
    ("picture", frozenset({"annotations"}), {}),
    ("group", frozenset({"name", "label"}), {}),
    ("group", frozenset({"children", "label"}), {}),
    ("item", frozenset({"label"}), {}),
)


def state(value: object) -> str:
    """The state of a JSON value, from the states of the parts that its transitions name."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "truth"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "ref" if value.startswith("#/") else "packed" if value.lstrip()[:1] in ("{", '"') else "string"
    if isinstance(value, list):
        return "array"
    for key in LINKS:
        if isinstance(value.get(key), str):
            return "link"
    for name, needed, parts in TRANSITIONS:
        if needed <= value.keys() and all(k not in value or state(value[k]) in ok for k, ok in parts.items()):
            return name
    return "object"


def link(value: object) -> str | None:
    """Where a link points, in either spelling of a link object or as a bare string."""
    if isinstance(value, str):
        return value or None
    if isinstance(value, dict):
        for key in LINKS:
            if isinstance(value.get(key), str) and value[key]:
                return value[key]
    return None


def unpack(text: str | None) -> dict | None:
    """The document of a record: unpacked from wrappers and from JSON within JSON; None if it isn't complete."""
    value: object = text
    while True:  # every step takes one wrapping off
        if isinstance(value, str):
            try:
                value = json.loads(value)
            except (ValueError, RecursionError):
                return None
        elif isinstance(value, dict):
            kind = state(value)
            if kind == "wrapper":
                value = value["document"]
            else:
                return value if kind == "document" else None
        else:
            return None


def _list(value: object) -> list:
    return value if isinstance(value, list) else []


def _int(value: object) -> int | None:
    return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) < 2**31 else None


def _real(value: object) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def _str(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _bool(value: object) -> bool | None:
    return value if isinstance(value, bool) else None


def elements(doc: dict) -> Iterator[tuple[str, int, object]]:
    """(array, position, element) of all items."""
    for array in ARRAYS:
        for n, element in enumerate(_list(doc.get(array))):
            yield array, n, element


def parents(doc: dict) -> dict[str, str]:
    """For each named item, the first element that names it among its children."""
    named: dict[str, str] = {}
    body = doc.get("body")
    for child in _list(body.get("children")) if isinstance(body, dict) else ():
        if (to := link(child)) is not None:
            named.setdefault(to, "#/body")
    for array, n, element in elements(doc):
        if isinstance(element, dict):
            for child in _list(element.get("children")):
                if (to := link(child)) is not None:
                    named.setdefault(to, f"#/{array}/{n}")
    return named


def variant(array: str, element: object) -> str:
    """The subtype of an item: the automaton's state, with the array's own kind where the state is a general one."""
    kind = state(element) if isinstance(element, dict) else "other"
    return {"texts": "text", "groups": "group", "tables": "table", "pictures": "picture"}[array] if kind in ("item", "object", "link", "string") else kind


def _items(rec_id: int, doc: dict) -> Iterator[tuple]:
    named = parents(doc)
    for array, n, x in elements(doc):
        ref, own = f"#/{array}/{n}", x if isinstance(x, dict) else {}
        up = link(own.get("parent"))
        yield (rec_id, ref, up if up is not None else named.get(ref, ""), array, n, variant(array, x), _str(own.get("label")), _str(own.get("name")), len(_list(own.get("children"))))


def _texts(rec_id: int, doc: dict) -> Iterator[tuple]:
    named = parents(doc)
    for array, n, x in elements(doc):
        if isinstance(x, dict) and "text" in x:
            ref = f"#/{array}/{n}"
            up = link(x.get("parent"))
            yield rec_id, ref, up if up is not None else named.get(ref, ""), variant(array, x), _int(x.get("level")), _bool(x.get("enumerated")), _str(x.get("text")), _str(x.get("orig"))


def _cells(rec_id: int, doc: dict) -> Iterator[tuple]:
    for array, n, x in elements(doc):
        data = x.get("data") if isinstance(x, dict) else None
        for k, c in enumerate(_list(data.get("table_cells")) if isinstance(data, dict) else ()):
            if isinstance(c, dict):
                head = any(c.get(h) is True for h in ("column_header", "row_header"))
                yield rec_id, f"#/{array}/{n}", k, _int(c.get("start_row_offset_idx")), _int(c.get("start_col_offset_idx")), _int(c.get("row_span", 1)), _int(c.get("col_span", 1)), head, _str(c.get("text"))


def _positions(rec_id: int, doc: dict) -> Iterator[tuple]:
    for array, n, x in elements(doc):
        for k, p in enumerate(_list(x.get("prov")) if isinstance(x, dict) else ()):
            if isinstance(p, dict):
                box = p.get("bbox") if isinstance(p.get("bbox"), dict) else {}
                span = [*_list(p.get("charspan")), None, None]
                yield rec_id, f"#/{array}/{n}", k, _int(p.get("page_no")), *(_real(box.get(e)) for e in "ltrb"), _str(box.get("coord_origin")), _int(span[0]), _int(span[1])


def _pages(rec_id: int, doc: dict) -> Iterator[tuple]:
    pages = doc.get("pages")
    listed = pages.items() if isinstance(pages, dict) else enumerate(_list(pages), 1)
    for key, p in listed:
        own = p if isinstance(p, dict) else {}
        size = own.get("size") if isinstance(own.get("size"), dict) else {}
        number = _int(own.get("page_no"))
        if number is None and str(key).isdecimal():
            number = _int(int(key))
        yield rec_id, number, _real(size.get("width")), _real(size.get("height"))


ROWS = {"items": _items, "texts": _texts, "cells": _cells, "positions": _positions, "pages": _pages}


def flatten(df: DataFrame, table: str, id_col: str = "rec_id", json_col: str = "json_structure") -> DataFrame:
    """One of the flat tables of ``df``'s structures, with distinct rows.

    One Arrow pass over (id, structure); only the narrow rows of the table are shuffled, to make records that
    were delivered twice count once."""
    make = ROWS[table]
    schema = df.sparkSession.createDataFrame([], SCHEMAS[table]).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for rec_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc = unpack(text.as_py())
                if doc is not None:
                    rows += make(rec_id, doc)
            columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    kept = df.select(df[id_col].cast("bigint").alias("rec_id"), df[json_col].alias("json_structure")).where("json_structure IS NOT NULL")
    return kept.mapInArrow(run, schema).distinct()
