"""Splitting of oversized texts at natural boundaries, by lexical cohesion.

A text is cut where the vocabulary changes most: at every boundary the words of the block before and the block after
are compared (cosine of counts); the depth of a valley is how far the similarity rises on both sides of it. In the
window of positions where the next piece may end, the deepest valley among the boundaries of the best kind wins:
paragraph ends, then line ends, then sentence ends. Where there is none of them it is the last space. A window that
holds no boundary at all is widened to the whole piece, and only where that holds none either it is the last character.
Then each piece is extended to the left by the overlap.

A piece with its overlap has at most max_chars code points. Pages are not marked in every text, so a limit on pages
becomes a limit on what a piece adds to the piece before: the share of the text that max_pages is of its pages.

Defined results: null and empty texts are never cut; a null limit does not apply; null pages exceed nothing; an
overlap is as long as asked, or all text before where that is shorter; one that leaves no room for new text within the
limit is an error; a limit below 2 characters is taken as 2; profiles given twice count once; records delivered twice count once.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.session import bounded

MAX_PROFILES = 1000
#: Part of the window in which a piece may end, counted from its far end.
WINDOW = 0.6
#: Words of the blocks that are compared on the two sides of a boundary.
BLOCK_WORDS = 60

_WORD = re.compile(r"\w{2,}")
_KINDS = (re.compile(r"\n[^\S\n]*\n\s*"), re.compile(r"\n+"), re.compile(r"(?<=[.!?。…])[\"')\]]*\s+"), re.compile(r"\s+"))
#: The first kinds, whose boundaries have a depth.
NATURAL = 3
_FENCE = re.compile(r"^(```|~~~).*?^\1[^\n]*$", re.S | re.M)
_TABLE = re.compile(r"(?:^\|.*(?:\n|\Z))+", re.M)


def boundaries(text: str) -> list[list[int]]:
    """Positions where the text may be cut, by kind, best first. Blank lines in code and line ends in tables don't count as paragraph ends."""
    inner = sorted((m.start(), m.end()) for r in (_FENCE, _TABLE) for m in r.finditer(text))
    starts = [a for a, _ in inner]

    def inside(p: int) -> bool:
        k = bisect_left(starts, p) - 1
        return k >= 0 and p < inner[k][1]

    best = [m.end() for m in _KINDS[0].finditer(text) if not inside(m.end())]
    return [best, *([m.end() for m in r.finditer(text)] for r in _KINDS[1:])]


def _cosine(a: Counter, b: Counter) -> float:
    if not a or not b:
        return 0.0
    return sum(n * b[w] for w, n in a.items() if w in b) / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


def depths(text: str, cuts: list[int]) -> dict[int, float]:
    """The depth of the cohesion valley at each position of ``cuts``, from block similarities that slide over the text."""
    at, said = [], []
    for m in _WORD.finditer(text):
        at.append(m.start())
        said.append(m[0].lower())
    similar = []
    for p in cuts:
        k = bisect_left(at, p)
        similar.append(_cosine(Counter(said[max(0, k - BLOCK_WORDS) : k]), Counter(said[k : k + BLOCK_WORDS])))
    n = len(similar)
    left, right = similar[:], similar[:]  # the height to which similarity rises without falling, on either side
    for i in range(1, n):
        left[i] = max(similar[i], left[i - 1]) if similar[i - 1] >= similar[i] else similar[i]
    for i in range(n - 2, -1, -1):
        right[i] = max(similar[i], right[i + 1]) if similar[i + 1] >= similar[i] else similar[i]
    return {p: left[i] + right[i] - 2 * similar[i] for i, p in enumerate(cuts)}


def cut(text: str, limit: int, fresh: int, overlap: int) -> list[tuple[int, int, int]]:
    """(begin, own, end) of the pieces: text[own:end] is new and text[begin:own] repeats the end of the piece before."""
    limit, size, overlap = max(2, limit), len(text), max(0, overlap)
    if overlap >= limit:
        raise ValueError(f"an overlap of {overlap} leaves no room for new text within {limit} characters")
    kinds = boundaries(text)
    valleys: dict[int, dict[int, float]] = {}  # by kind, when first needed

    def best(first: int, last: int) -> int:
        """The deepest valley between first and last of the best kind that is there; 0 if there is none."""
        for level, places in enumerate(kinds):
            lo, hi = bisect_left(places, first), bisect_right(places, last)
            if lo < hi:
                if level >= NATURAL:
                    return places[hi - 1]
                if level not in valleys:
                    valleys[level] = depths(text, places)
                return max(places[lo:hi], key=lambda p: (valleys[level][p], p))
        return 0

    out, own = [], 0
    while own < size:
        begin = max(0, own - overlap)
        last = min(begin + limit, own + max(1, fresh))
        if last >= size:
            out.append((begin, own, size))
            break
        # first where a piece is well filled, then anywhere in it, before it is cut at any character
        end = best(own + max(1, int((last - own) * (1 - WINDOW))), last) or best(own + 1, last) or last
        out.append((begin, own, end))
        own = end
    return out


def limits(profiles: DataFrame) -> list[tuple[str, int | None, int | None, int]]:
    rows = bounded(profiles.select("profile", "max_chars", "max_pages", "overlap_chars").distinct(), MAX_PROFILES, "the table of profiles")
    known = sorted(((r[0], r[1], r[2], r[3] or 0) for r in rows), key=str)
    for name, chars, _, overlap in known:
        if chars is not None and overlap >= max(2, chars):
            raise ValueError(f"profile {name}: an overlap of {overlap} leaves no room for new text within {chars} characters")
    return known


def oversized(df: DataFrame, profiles: list, id_col: str, text_col: str, pages_col: str) -> DataFrame:
    """Records that exceed a limit, once each, with the profiles they exceed; small ones never leave the scan."""
    chars, pages = F.char_length(df[text_col]), df[pages_col]
    over = [F.when(F.coalesce(F.lit(False) if c is None else chars > c, F.lit(False)) | F.coalesce(F.lit(False) if p is None else pages > p, F.lit(False)), F.lit(k)) for k, (_, c, p, _) in enumerate(profiles)]
    which = F.array_compact(F.array(*over)) if over else F.array().cast("array<int>")
    found = df.select(df[id_col].cast("bigint").alias("rec_id"), df[text_col].alias("text"), pages.cast("int").alias("pages"), which.alias("which"))
    return found.where((F.char_length("text") > 0) & (F.size("which") > 0))


def pieces(df: DataFrame, profiles: DataFrame, id_col: str = "rec_id", text_col: str = "markdown", pages_col: str = "pages") -> DataFrame:
    """(profile, rec_id, piece_no, begin_char, own_char, end_char, piece): the ordered pieces of all oversized records."""
    known = limits(profiles)
    found = oversized(df, known, id_col, text_col, pages_col).dropDuplicates(["rec_id"])
    schema = "profile string, rec_id bigint, piece_no int, begin_char int, own_char int, end_char int, piece string"
    arrow = pa.schema([("profile", pa.string()), ("rec_id", pa.int64()), *((c, pa.int32()) for c in ("piece_no", "begin_char", "own_char", "end_char")), ("piece", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rec_id, text, pages, which in zip(*(b.column(k) for k in range(4)), strict=True):
                rec_id, text, pages = rec_id.as_py(), text.as_py(), pages.as_py()
                for k in which.as_py():
                    name, chars, most, overlap = known[k]
                    limit = chars if chars is not None else len(text) + overlap
                    fresh = len(text) * most // pages if most is not None and pages is not None and pages > most else limit
                    rows = [(name, rec_id, n, a, o, e, text[a:e]) for n, (a, o, e) in enumerate(cut(text, limit, max(1, fresh), overlap), 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return found.mapInArrow(run, schema)
