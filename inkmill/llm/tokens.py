"""Encoding of a corpus with a public byte-level BPE, by a table of distinct words.

Spark splits every text into the tokenizer's words; each distinct word is encoded once; the ids come back to the
texts by a join on the word, in order of position. Words that make up a large share of all words are few by definition, so they
are joined by broadcast and never make a hot key of the shuffle join (plans/skew.py).

Defined results: null and empty texts have an empty list; a text that is only white space is encoded like any
other; a null document id is kept; a document id that stands twice is encoded once per id and text.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.plans.session import written
from inkmill.plans.skew import join_counted

TOKENIZER = "byte_bpe_50k.tiktoken"


def tokenizer_file(name: str = TOKENIZER) -> str:
    """Path of a public vocabulary file; the folder is taken from INKMILL_TOKENIZERS or the installed package."""
    if folder := os.environ.get("INKMILL_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    """The tokenizer's word pattern for Java's regular expressions, with Unicode classes."""
    import public_tokenizers

    return "(?U)" + public_tokenizers.PATTERN


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, version, pos, word) of all texts; version is a hash of the text. Written once, as the words are both counted and joined."""
    split = F.regexp_extract_all(df[text_col], F.lit(word_pattern()), F.lit(0))
    return written(df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text_col]).alias("version"), F.posexplode(split).alias("pos", "word")), "text-words")


def word_table(said: DataFrame, path: str | None = None) -> DataFrame:
    """(word, n, ids): every distinct word of a table of words with its number and its ids; written once."""
    path = path or tokenizer_file()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(path)
        for b in batches:
            ids = [own.encode_ordinary(w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["word", "n", "ids"])

    counted = said.groupBy("word").agg(F.count("*").alias("n"))
    return written(counted.mapInArrow(encode, "word string, n bigint, ids array<int>"), "words")


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every text, without special tokens; one row for each id and text."""
    df = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    said = words(df, "doc_id", "text")
    joined = join_counted(said, word_table(said, path), "word", "n", ["ids"])
    # a row given several times has each of its words as often, side by side once they are sorted
    copies = (F.count("*") / (F.max("pos") + 1)).cast("int")
    ordered = joined.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("parts"), copies.alias("copies"))
    once = F.when(F.col("copies") > 1, F.filter("parts", lambda x, i: i % F.col("copies") == 0)).otherwise(F.col("parts"))
    spelt = ordered.select("doc_id", once.alias("parts")).select("doc_id", F.flatten(F.col("parts.ids")).alias("ids"))
    none = df.where("text IS NULL OR text = ''").select("doc_id").distinct().select("doc_id", F.array().cast("array<int>").alias("ids"))
    return spelt.unionByName(none)


def counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, tokens): the number of ids of every text; 0 for null and empty texts; one row for each id and text."""
    df = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    said = words(df, "doc_id", "text")
    sized = join_counted(said, word_table(said, path).withColumn("k", F.size("ids")), "word", "n", ["k"])
    copies = F.count("*") / (F.max("pos") + 1)
    sizes = sized.groupBy("doc_id", "version").agg((F.sum("k") / copies).cast("bigint").alias("tokens")).drop("version")
    none = df.where("text IS NULL OR text = ''").select("doc_id").distinct().select("doc_id", F.lit(0).cast("bigint").alias("tokens"))
    return sizes.unionByName(none)


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece): the vocabulary, whose size is fixed, so that it may be broadcast."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in ranks(path or tokenizer_file()).items()], "id int, piece binary")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text): texts of lists of ids, by a join with the vocabulary. An empty or null list gives an empty text."""
    spelt = df.select(df[id_col].alias("doc_id"), F.posexplode_outer(df[ids_col]).alias("pos", "id"))
    joined = spelt.join(F.broadcast(piece_table(df.sparkSession, path)), "id", "left")
    parts = joined.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", F.hex("piece").alias("piece")))).alias("parts"))
    return parts.select("doc_id", F.decode(F.unhex(F.array_join(F.col("parts.piece"), "")), "UTF-8").alias("text"))
