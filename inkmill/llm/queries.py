"""Queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import abuse, mail, mixing, neardup, personal, reply, scans, splitting, tokens
from inkmill.plans.session import load, written


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    return written(mail.bodies(load(spark, d, "thread")), "bodies")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(load(spark, d, "docling")).select("rec_id", F.explode("noise").alias("noise"))


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every record once: repaired where it has noise, else as it is."""
    docs = load(spark, d, "docling").select("rec_id", "markdown", "doctags").dropDuplicates(["rec_id"])
    mended = scans.repaired(docs).select("rec_id", F.struct("markdown", "doctags").alias("new"))
    both = docs.join(mended, "rec_id", "left")
    return both.select("rec_id", *(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in ("markdown", "doctags")), F.col("new").isNotNull().alias("repaired"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return reply.classified(mail.bodies(load(spark, d, "thread"))).select("tid", "msg_id", F.explode("kinds").alias("kind"))


def p2_new_text(spark: SparkSession, d: str) -> DataFrame:
    return reply.classified(mail.bodies(load(spark, d, "thread"))).select("tid", "msg_id", "new_text")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    cut = splitting.pieces(load(spark, d, "docling"), load(spark, d, "split_profile"))
    return cut.where("piece_no = 1").select("profile", "rec_id")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.pieces(load(spark, d, "docling"), load(spark, d, "split_profile"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_pairs(load(spark, d, "docling"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(load(spark, d, "docling"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """The texts searched for personal information: markdown of records and bodies of messages."""
    pages = load(spark, d, "docling").select(F.lit("docling").alias("origin_table"), F.col("rec_id").cast("string").alias("ref_id"), F.col("markdown").alias("text"))
    return pages.unionByName(_bodies(spark, d).select(F.lit("thread").alias("origin_table"), F.col("msg_id").alias("ref_id"), F.col("body").alias("text")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.judged(personal.candidates(_texts(spark, d))).select("origin_table", "ref_id", "kind", "found").distinct()


def p6_redacted(spark: SparkSession, d: str) -> DataFrame:
    texts = _texts(spark, d)
    return personal.redact(texts, personal.judged(personal.candidates(texts)))


def p6_terms(spark: SparkSession, d: str) -> DataFrame:
    return personal.disclosure(personal.candidates(_texts(spark, d)))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(load(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decode(tokens.encode(load(spark, d, "documents")))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, d, "documents")
    sizes = tokens.counts(docs)
    return mixing.mix(written(docs.select("doc_id", "source").join(sizes, "doc_id"), "sizes"), load(spark, d, "mix_target"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p8_sample(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def _scored(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents")
    return abuse.score(docs, abuse.fit_from(docs, load(spark, d, "doc_label")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("abusive").select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(_scored(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_new_text, p3_found, p3_pieces, p5_found, p5_groups, p6_found, p6_redacted, p6_terms, p7_ids, p7_decoded, p8_report, p8_sample, p9_found, p9_scores, p9_rates)}

SQL: dict[str, str] = {
    "p3_found": """
        SELECT DISTINCT p.profile, d.rec_id FROM docling d, split_profile p
        WHERE length(d.markdown) > 0 AND (length(d.markdown) > p.max_chars OR d.pages > p.max_pages)""",
    "p5_found": r"""
        WITH w AS (SELECT DISTINCT rec_id, list_filter(string_split_regex(lower(markdown), '[ \t\r\n]+'), lambda x: x <> '') AS w FROM docling WHERE markdown IS NOT NULL),
        g AS (SELECT DISTINCT rec_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2])) AS g FROM w WHERE len(w) >= 3),
        n AS (SELECT rec_id, count(*) AS n FROM g GROUP BY rec_id),
        s AS (SELECT a.rec_id AS rec_a, b.rec_id AS rec_b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.rec_id < b.rec_id GROUP BY ALL)
        SELECT rec_a, rec_b FROM s JOIN n x ON x.rec_id = rec_a JOIN n y ON y.rec_id = rec_b WHERE k >= 0.7 * (x.n + y.n - k)""",
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
