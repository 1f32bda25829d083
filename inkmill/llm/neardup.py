"""Near-duplicate records by odd sketches.

Each text becomes its set of hashed word shingles, MinHash samples of that set, and an odd sketch: a bitmap in which
every sample flips one bit. The population count of the XOR of two bitmaps estimates how many samples differ, and with
it the likeness. Candidates are texts that share a band of samples; a pair is verified by its bitmaps inside the
band join, in generated code, and the pairs that remain are compared exactly on their shingle sets.

Texts with equal shingle sets are one class, and only classes are compared. A band that many classes share is dealt
to blocks by a hash of the class, and the join runs over pairs of blocks, so one hot band never makes one task.

Chance of a miss: at likeness 0.7 no band of ROWS samples agrees with (1 - 0.7 ** ROWS) ** BANDS, about 2e-8; the
odd sketch passes pairs down to an estimate of MARGIN below the threshold, more than four standard deviations.

Defined results: null texts and texts of fewer words than a shingle have no links; equal texts are alike by 1;
records delivered twice count once; a null id is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.session import written
from inkmill.plans.skew import join_counted, join_salted

ROWS, BANDS = 4, 64
SKETCH_BITS = 1024
#: How far below the threshold an estimate may be for a pair to be compared exactly.
MARGIN = 0.2
#: Classes of one band that are joined in one block.
BLOCK = 512

_PRIME = np.uint64((1 << 61) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words of a text. Words are split at space, tab, CR and LF."""
    import xxhash

    words = text.lower().translate({9: 32, 10: 32, 13: 32}).split(" ")
    words = [w for w in words if w]
    if len(words) < k:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    known: dict[str, int] = {}
    for w in words:
        if w not in known:
            known[w] = digest(w.encode("utf-8", "surrogatepass"))
    own = np.fromiter((known[w] for w in words), np.uint64, len(words))
    run = own[: len(own) - k + 1].copy()
    for i in range(1, k):
        run = _mix(run * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - k + 1 + i])
    return np.unique(run)


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def samples(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash samples, one for each of the multiply-add functions; blockwise, so memory doesn't follow the text."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        part = hashes[i : i + 2048, None] * a[None, :]
        part += b[None, :]
        part ^= part >> np.uint64(32)
        np.minimum(low, part.min(axis=0), out=low)
    return low


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """The parity bitmap of the samples, as signed 64-bit words."""
    bits = (_mix(low + np.arange(len(low), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def differing(threshold: float) -> int:
    """The largest number of differing bits that a pair may have at an estimate of threshold - MARGIN.

    Two sets that differ in a share d of n samples flip 2 d n bits between them; of m bits about
    m / 2 * (1 - exp(-4 d n / m)) are then odd."""
    far = 1 - max(0.0, threshold - MARGIN)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * far * BANDS * ROWS / SKETCH_BITS)))


def sketches(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(rec_id, cls, n, hashes, bands, sketch) of all texts that have shingles."""
    kept = df.select(df[id_col].cast("bigint").alias("rec_id"), df[text_col].alias("text")).where("rec_id IS NOT NULL AND text IS NOT NULL")
    schema = "rec_id bigint, cls string, n int, hashes array<bigint>, bands array<bigint>, sketch array<bigint>"
    longs = pa.list_(pa.int64())
    arrow = pa.schema([("rec_id", pa.int64()), ("cls", pa.string()), ("n", pa.int32()), ("hashes", longs), ("bands", longs), ("sketch", longs)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        a, b = _parameters()
        number = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            rows = []
            for rec_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingles(text.as_py(), k)
                if len(own):
                    low = samples(own, a, b)
                    keys = number.copy()
                    for r in range(ROWS):
                        keys = _mix(keys + low.reshape(BANDS, ROWS)[:, r])
                    rows.append((rec_id, xxhash.xxh3_128_hexdigest(own.tobytes()), len(own), own.view(np.int64), keys.view(np.int64), odd_sketch(low)))
            columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return kept.mapInArrow(run, schema)


def class_links(sketched: DataFrame, threshold: float) -> DataFrame:
    """(cls_a, cls_b, likeness) of all pairs of classes that are alike by the threshold, cls_a < cls_b."""
    classes = sketched.groupBy("cls").agg(F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    banded = classes.select("cls", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    # only bands that at least two classes share go on; few classes are in any of them
    members = join_counted(banded, written(shared, "shared-bands"), "band", "m", ["m"]).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    members = members.join(classes.select("cls", "n", *(F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_BITS // 64))), "cls")
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    cells = members.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cls", "n", "band", *(f"s{i}" for i in range(SKETCH_BITS // 64)), F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own")
    a, b = (cells.select(*(F.col(c).alias(f"{c}_{side}") for c in cells.columns)) for side in "ab")
    odd = sum((F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    same = (F.col("band_a") == F.col("band_b")) & (F.col("x_a") == F.col("x_b")) & (F.col("y_a") == F.col("y_b"))
    sizes = F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b")
    # in the cell of a block with itself all pairs meet; in a cell of two blocks only pairs across them
    across = (F.col("x_a") == F.col("y_a")) | (F.col("own_a") != F.col("own_b"))
    near = a.join(b, same & across & (F.col("cls_a") < F.col("cls_b")) & sizes & (odd <= differing(threshold)))
    pairs = near.select("cls_a", "cls_b").distinct()
    sets = sketched.groupBy("cls").agg(F.any_value("hashes").alias("hashes"))
    held = pairs.join(sets.select(F.col("cls").alias("cls_a"), F.col("hashes").alias("h_a")), "cls_a").join(sets.select(F.col("cls").alias("cls_b"), F.col("hashes").alias("h_b")), "cls_b")
    both = F.size(F.array_intersect("h_a", "h_b"))
    scored = held.select("cls_a", "cls_b", both.alias("both"), (F.size("h_a") + F.size("h_b")).alias("sum"))
    return scored.select("cls_a", "cls_b", (F.col("both") / (F.col("sum") - F.col("both"))).alias("likeness")).where(F.col("likeness") >= threshold)


def near_pairs(df: DataFrame, id_col: str = "rec_id", text_col: str = "markdown", k: int = 3, threshold: float = 0.7) -> DataFrame:
    """(rec_a, rec_b): all pairs of records that are alike by the threshold, rec_a < rec_b, copies included."""
    sketched = written(sketches(df, id_col, text_col, k), "sketches")
    members = sketched.select("rec_id", "cls").distinct()
    links = class_links(sketched, threshold)
    x, y = members.select(F.col("rec_id").alias("p"), F.col("cls").alias("cls_a")), members.select(F.col("rec_id").alias("q"), F.col("cls").alias("cls_b"))
    links = written(links.select("cls_a", "cls_b"), "links")
    # the members of a class with many copies are spread over salts, links being few
    between = join_salted(y, join_salted(x, links, "cls_a", "p"), "cls_b", "q").where("p != q").select(F.least("p", "q").alias("rec_a"), F.greatest("p", "q").alias("rec_b"))
    # copies meet in blocks: a class of k of them is k / BLOCK keys of the join, not one
    sizes = written(members.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1"), "class-sizes")
    several = join_counted(members, sizes, "cls", "n", ["n"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = several.select(F.col("rec_id").alias("rec_a"), "cls", F.pmod(F.xxhash64("rec_id"), F.col("blocks")).cast("int").alias("block"))
    other = several.select(F.col("rec_id").alias("rec_b"), "cls", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    copies = own.join(other, ["cls", "block"]).where("rec_a < rec_b").select("rec_a", "rec_b")
    return between.unionByName(copies).distinct()


def groups(df: DataFrame, id_col: str = "rec_id", text_col: str = "markdown", k: int = 3, threshold: float = 0.7, most_rounds: int = 60) -> DataFrame:
    """(rec_id, class_id, group_id, links): one row for each record that has shingles.

    class_id is the smallest record with an equal set of shingles, group_id the smallest record reached over links,
    links the number of other classes it is linked to. Labels travel along links and jump over their own targets, so
    rounds grow with the logarithm of the longest chain; every round ends in a written table."""
    sketched = written(sketches(df, id_col, text_col, k), "sketches")
    members = sketched.groupBy("rec_id").agg(F.min("cls").alias("cls"))
    least = members.groupBy("cls").agg(F.min("rec_id").alias("class_id"))
    links = written(class_links(sketched, threshold).select("cls_a", "cls_b"), "links")
    both = links.unionByName(links.select(F.col("cls_b").alias("cls_a"), F.col("cls_a").alias("cls_b")))
    named = least.select(F.col("cls").alias("cls_a"), F.col("class_id").alias("a")), least.select(F.col("cls").alias("cls_b"), F.col("class_id").alias("b"))
    edges = written(both.join(named[0], "cls_a").join(named[1], "cls_b").select("a", "b"), "edges")
    label = written(edges.select(F.col("a").alias("v"), F.col("a").alias("g")).distinct(), "labels")
    for _ in range(most_rounds):
        near = edges.join(label, edges.b == label.v).groupBy("a").agg(F.min("g").alias("h"))
        lower = label.join(near, label.v == near.a, "left").select("v", "g", F.least("g", F.coalesce("h", "g")).alias("h"))
        jump = label.select(F.col("v").alias("h"), F.col("g").alias("far"))
        label = written(lower.join(jump, "h", "left").select("v", F.col("g").alias("old"), F.least("h", F.coalesce("far", "h")).alias("g")), "labels")
        if label.where("old != g").isEmpty():
            break
    else:
        raise RuntimeError(f"labels still move after {most_rounds} rounds")
    degree = edges.groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"))
    spread = least.join(label.select(F.col("v").alias("class_id"), "g"), "class_id", "left").join(degree, "class_id", "left")
    rows = spread.select("cls", "class_id", F.coalesce("g", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
    return members.join(rows, "cls").select("rec_id", "class_id", "group_id", "links")
