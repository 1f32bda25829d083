"""Streams: jobs from a folder, entries once each, retries by state, and delivery through an outbox.

Every flow runs with the trigger availableNow, so that a scheduler may start it again and again; one checkpoint has one
writer. The set of seen keys and the retry counts have no expiry, as entries may come back at any time; their state
grows with the number of keys, and a key's state goes when it is reported as gone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB = "id string, question string, reply_channel string, reply_target string"


def jobs(spark: SparkSession, folder: str, schema: str = JOB) -> DataFrame:
    """The jobs of a folder of JSON files; those without a question are none."""
    return spark.readStream.schema(schema).json(folder).where("trim(coalesce(question, '')) != ''")


def once(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's first row."""
    return stream.dropDuplicates(keys)


def drained(stream: DataFrame, checkpoint: str, deliver: Callable[[DataFrame, int], None]) -> None:
    """Runs a stream over all that is there; ``deliver`` gets each batch."""
    stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def outbox(folder: str, send: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A delivery that keeps each batch before it sends it, tries what failed once more, and then marks it unsent.

    ``send`` gets rows and gives (id, sent). A batch that runs again overwrites its own files."""

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = f"{folder}/answers/batch={number}"
        batch.write.mode("overwrite").parquet(kept)
        rows = spark.read.parquet(kept)
        first = send(rows)
        first.write.mode("overwrite").parquet(f"{folder}/try1/batch={number}")
        first = spark.read.parquet(f"{folder}/try1/batch={number}")
        again = rows.join(first.where("NOT sent"), "id", "left_semi")
        second = send(again).select("id", F.col("sent").alias("sent2"))
        state = rows.select("id").join(first, "id", "left").join(second, "id", "left").select("id", F.when(F.coalesce("sent", F.lit(False)) | F.coalesce("sent2", F.lit(False)), "sent").otherwise("unsent").alias("state"))
        state.write.mode("overwrite").parquet(f"{folder}/state/batch={number}")

    return deliver


RETRY = "item string, outcome string, fails int, given_up boolean"


def retries(attempts: DataFrame, give_up: int = 2) -> DataFrame:
    """(item, outcome, fails, given_up) after each batch of a stream of (item, outcome, at).

    A failure adds one; a success, or the item being gone, clears the count. Outcomes: failed, done, gone."""
    import pandas as pd

    def step(key: tuple, frames: Iterator, state) -> Iterator:
        fails = state.get[0] if state.exists else 0
        last = None
        for f in frames:
            for outcome in f.sort_values("at")["outcome"]:
                fails, last = (fails + 1, outcome) if outcome == "failed" else (0, outcome)
        if fails:
            state.update((fails,))
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(key[0], last, fails, fails >= give_up)], columns=["item", "outcome", "fails", "given_up"])

    return attempts.groupBy("item").applyInPandasWithState(step, RETRY, "fails int", "update", "NoTimeout")


def retry_counts(attempts: DataFrame, give_up: int = 2) -> DataFrame:
    """The same for a table: failures since the last success of each item."""
    good = attempts.groupBy("item").agg(F.max(F.when(F.col("outcome") != "failed", F.col("at"))).alias("cleared"))
    since = attempts.join(good, "item").where("outcome = 'failed' AND (cleared IS NULL OR at > cleared)")
    return since.groupBy("item").agg(F.count("*").cast("int").alias("fails"), (F.count("*") >= give_up).alias("given_up"))
