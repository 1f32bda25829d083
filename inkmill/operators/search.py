"""Top-k search: every query row against all rows, by shared terms or by cosine.

Queries are the rows whose id is divisible by EVERY. They meet all rows in blocks of BLOCK: a block is broadcast, its
size being fixed, and one scan of the rows scores it; each task keeps only its own k best for each query, so what is
shuffled is k rows for each query and task. Nothing is left out: a word counts however many rows hold it.

Defined results: rows with a null id are in no result; a null or empty text shares nothing; a null or zero vector is
near to nothing; ties go to the smaller id; an id that stands twice is two rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVERY = 100
#: Queries of one broadcast block, and those of them that are scored at a time.
BLOCK, AT_ONCE = 8192, 1024



class _Terms:
    """Scores rows of words by the number of words that they share with each query."""

    def __init__(self, words: list[list[str]]) -> None:
        self.words = words

    def of(self, part: slice) -> Callable[[list], np.ndarray]:
        own = self.words[part]
        stands: dict[str, list[int]] = {}
        for q, said in enumerate(own):
            for w in said:
                stands.setdefault(w, []).append(q)
        places = {w: np.array(q, np.int32) for w, q in stands.items()}

        def score(values: list) -> np.ndarray:
            out = np.zeros((len(values), len(own)), np.int64)
            for r, said in enumerate(values):
                met = [places[w] for w in said if w in places]
                if met:
                    out[r] = np.bincount(np.concatenate(met), minlength=len(own))
            return np.where(out > 0, out, -1)

        return score


class _Cosines:
    """Scores rows of vectors by their cosine with each query, in millionths above -1."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    def of(self, part: slice) -> Callable[[list], np.ndarray]:
        own = self.vectors[part].T

        def score(values: list) -> np.ndarray:
            x = np.array(values, np.float64)
            return np.rint((x / np.linalg.norm(x, axis=1, keepdims=True)) @ own * 1e6).astype(np.int64) + 1_000_000

        return score


def word_set(text: Column) -> Column:
    """The distinct lower-case words of a text: runs of letters and digits of any script."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), each (k, queries): the k best rows of every query; ids must ascend, scores below 0 are none."""
    n = len(ids)
    key = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)[:, None]
    top = np.argpartition(-key, min(k, n) - 1, axis=0)[: min(k, n)]
    return ids[top], np.take_along_axis(scores, top, axis=0)


def _scan(rows: DataFrame, blocks: Iterator[tuple[list, _Terms | _Cosines]], k: int) -> DataFrame:
    """(query, hit, score, place) of rows (id, v). Each block has the ids of its queries and what scores rows against
    some of them: whole numbers (rows, queries), below 0 for no hit."""
    spark, found = rows.sparkSession, None
    schema = pa.schema([("query", pa.int64()), ("hit", pa.int64()), ("score", pa.int64())])
    for query_ids, scorer in blocks:
        own = spark.sparkContext.broadcast((np.array(query_ids, np.int64), scorer))

        def run(batches, own=own):
            asked, scorer = own.value
            parts = [slice(a, a + AT_ONCE) for a in range(0, len(asked), AT_ONCE)]
            scorers = [scorer.of(p) for p in parts]
            kept = [(np.zeros((0, len(asked[p])), np.int64), np.zeros((0, len(asked[p])), np.int64)) for p in parts]
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                values = batch.column(1).to_pylist()
                values = [values[j] for j in order]
                ids = ids[order]
                for n, (p, score) in enumerate(zip(parts, scorers, strict=True)):
                    s = np.where(ids[:, None] == asked[p][None, :], -1, score(values))
                    new_ids, new = _best(ids, s, k)
                    both, all_ = np.concatenate([kept[n][1], new]), np.concatenate([kept[n][0], new_ids])
                    top = np.lexsort((all_, -both), axis=0)[:k]
                    kept[n] = np.take_along_axis(all_, top, axis=0), np.take_along_axis(both, top, axis=0)
            for p, (hits, scores) in zip(parts, kept, strict=True):
                place, q = np.nonzero(scores >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(asked[p][q]), pa.array(hits[place, q]), pa.array(scores[place, q])], schema=schema)

        part = rows.mapInArrow(run, "query bigint, hit bigint, score bigint")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query bigint, hit bigint, score bigint, place int")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "hit"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _blocks(rows: DataFrame, every: int) -> Iterator[list]:
    """The query rows in blocks of about BLOCK rows; at no time is more than one of them on the driver."""
    asked = rows.where(F.col("id") % every == 0)
    many = -(-asked.count() // BLOCK)
    for number in range(many):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(many)) == number).collect()
        if own:
            yield own


def by_terms(docs: DataFrame, id_col: str, text_col: str, k: int = 5, every: int = EVERY) -> DataFrame:
    """(query, hit, shared, place): the k rows that share most distinct words with a query row."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), word_set(F.col(text_col)).alias("v"))

    found = _scan(rows, (([r["id"] for r in b], _Terms([r["v"] for r in b])) for b in _blocks(rows, every)), k)
    return found.select("query", "hit", F.col("score").alias("shared"), "place")


def by_cosine(vectors: DataFrame, id_col: str, vec_col: str, k: int = 5, every: int = EVERY) -> DataFrame:
    """(query, hit, score, place): the k nearest rows of each query row by cosine, rounded to six places."""
    rows = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.exists("v", lambda x: x != 0))

    found = _scan(rows, (([r["id"] for r in b], _Cosines(np.array([r["v"] for r in b], np.float64))) for b in _blocks(rows, every)), k)
    return found.select("query", "hit", ((F.col("score") - 1_000_000) / 1e6).alias("score"), "place")
