"""Mixing of sources to target weights.

Each run wants ``size_ratio`` times the tokens of all documents, divided among its sources by relative weight; a
source gives at most ``max_repeat`` times its own tokens. Whole epochs of a source take all its documents; the last,
partial epoch takes a prefix of a permutation of them. The documents of an epoch lie in permuted blocks, and a
splitting tree deals the blocks to output shards: each node divides the exact block quotas of the sources between its
two halves by one multivariate hypergeometric draw. A shard is then shuffled on its own.

The tree is never laid out: a node's draw follows from the numbers of its place and of the run alone, so each block walks
from the root to its own shard, and neither the driver nor any task holds a list of shards. Prefix sums are taken in
steps, over chunks of blocks, over the blocks of a chunk, and within the one block where the quota ends, so no task
ever sees a whole source. The number of blocks and of shards follows the data.

Defined results: a source without documents, or with only empty ones, contributes nothing and is reported with 0; a
null or negative weight or size counts as 0; a null max_repeat as 1; documents without a source are in no mix;
repeated lines of the targets count once; texts that stand under several ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.plans.session import bounded, written

#: Most lines of the table of targets, which is a setting and not data.
MAX_TARGETS = 10_000
BLOCK_DOCS = 512
#: Blocks whose sizes are summed up by one window.
CHUNK = 4096
SHARD_TOKENS = 4_000_000
#: Nodes of the tree that a task remembers.
NODES = 100_000


class Tree:
    """A binary tree over ``leaves`` shards that deals exact quotas of blocks. Its nodes are drawn when first passed."""

    def __init__(self, quotas: list[int], leaves: int, seed: tuple[int, ...]) -> None:
        self.root, self.leaves, self.seed = np.array(quotas, np.int64), leaves, seed
        self.takes: dict[tuple[int, int], np.ndarray] = {}

    def _left(self, first: int, leaves: int, quotas: np.ndarray) -> np.ndarray:
        """What the left half of the node over ``leaves`` shards from ``first`` on gets of its quotas."""
        key = (first, leaves)
        if key not in self.takes:
            if len(self.takes) >= NODES:
                self.takes.clear()
            total = int(quotas.sum())
            rng = np.random.default_rng((*self.seed, first, leaves))
            self.takes[key] = rng.multivariate_hypergeometric(quotas, total * (leaves // 2) // leaves, method="marginals") if total else quotas
        return self.takes[key]

    def shard(self, source: int, number: int) -> int:
        """The shard of a source's block."""
        first, leaves, quotas = 0, self.leaves, self.root
        while leaves > 1:
            take = self._left(first, leaves, quotas)
            if number < take[source]:
                leaves, quotas = leaves // 2, take
            else:
                number, first, quotas, leaves = number - int(take[source]), first + leaves // 2, quotas - take, leaves - leaves // 2
        return first


def dealt(blocks: DataFrame, runs: dict[str, tuple[int, dict[str, tuple[int, int]]]], seed: int) -> DataFrame:
    """``blocks`` (run_name, source, seq, ...) with their shard. runs: number of the run, and of each of its sources the number and quota; of the size of the targets."""
    names = blocks.columns
    schema = pa.schema([*((n, pa.string()) for n in ("run_name", "source")), ("epoch", pa.int32()), *((n, pa.int64()) for n in ("block", "start", "size")), ("shard", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Tree] = {}
        for batch in batches:
            shards = []
            for name, source, seq in zip(*(batch.column(names.index(c)).to_pylist() for c in ("run_name", "source", "seq")), strict=True):
                leaves, sources = runs[name]
                if name not in trees:
                    own = sorted(sources.values())
                    trees[name] = Tree([q for _, q in own], leaves, (seed, sorted(runs, key=str).index(name)))
                shards.append(trees[name].shard(sources[source][0], seq))
            kept = [batch.column(names.index(f.name)) for f in schema if f.name != "shard"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(shards, pa.int32())], schema=schema)

    return blocks.mapInArrow(run, "run_name string, source string, epoch int, block bigint, start bigint, size bigint, shard int")


def plan(sizes: DataFrame, targets: DataFrame) -> tuple[list[dict], int]:
    """What each source of each run shall give: one entry per line of the targets; and all tokens."""
    own = targets.select("run_name", "source", "weight", "max_repeat", "size_ratio").distinct()
    lines = [r.asDict() for r in bounded(own, MAX_TARGETS, "the table of targets")]
    named = sorted({x["source"] for x in lines if x["source"] is not None})
    there = {r["source"]: r for r in bounded(sizes.where(F.col("source").isin(named)).groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), MAX_TARGETS, "the sources of the targets")}
    total = int(sizes.agg(F.sum("tokens")).first()[0] or 0)
    weights: dict[str, float] = {}
    for x in lines:
        x["weight"] = max(0.0, x["weight"] or 0.0)
        weights[x["run_name"]] = weights.get(x["run_name"], 0.0) + x["weight"]
    for x in lines:
        r = there.get(x["source"])
        x["have"], x["docs"] = (int(r["tokens"]), int(r["docs"])) if r else (0, 0)
        x["share"] = x["weight"] / weights[x["run_name"]] if weights[x["run_name"]] else 0.0
        x["wanted"] = int(round(x["share"] * max(0.0, x["size_ratio"] or 0.0) * total))
        most = 1 if x["max_repeat"] is None else max(0, x["max_repeat"])
        quota = min(x["wanted"], most * x["have"])
        x["epochs"], x["rest"] = divmod(quota, x["have"]) if x["have"] else (0, 0)
        x["blocks"] = max(1, -(-x["docs"] // BLOCK_DOCS))
    return sorted(lines, key=lambda x: (str(x["run_name"]), str(x["source"]))), total


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(sample, report) of a table of (doc_id, source, tokens).

    sample: run_name, source, shard, place, doc_id, repeat, tokens. report: one row for each run and source."""
    spark = sizes.sparkSession
    lines, _ = plan(sizes, targets)
    schema = "run_name string, source string, epoch int, blocks bigint, rest bigint"
    epochs = [(x["run_name"], x["source"], e, x["blocks"], None if e < x["epochs"] else x["rest"]) for x in lines for e in range(x["epochs"] + (x["rest"] > 0))]
    turns = F.broadcast(spark.createDataFrame(epochs, schema))
    salt = F.xxhash64(F.col("doc_id"), F.col("run_name"), F.col("epoch"), F.lit(seed))
    drawn = (
        sizes.where("tokens > 0").join(turns, "source").withColumn("mark", salt)
        .withColumn("block", F.expr("CAST(floor((mark / 18446744073709551616D + 0.5D) * blocks) AS BIGINT)"))
        .withColumn("block", F.least(F.col("block"), F.col("blocks") - 1))
    )
    key = ["run_name", "source", "epoch"]
    # prefix sums over chunks, over the blocks of a chunk, then within the one block of each partial epoch where the quota ends
    per_block = written(drawn.groupBy(*key, "block", "rest").agg(F.sum("tokens").alias("size")).withColumn("chunk", F.floor(F.col("block") / CHUNK)), "block-sizes")
    per_chunk = per_block.groupBy(*key, "chunk").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    none = F.lit(0).cast("bigint")
    chunks = per_chunk.select(
        *key, "chunk",
        F.coalesce(F.sum("s").over(Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), none).alias("s_before"),
        F.coalesce(F.sum("n").over(Window.partitionBy("run_name", "source").orderBy("epoch", "chunk").rowsBetween(Window.unboundedPreceding, -1)), none).alias("n_before"),
    )
    inside = Window.partitionBy(*key, "chunk").orderBy("block")
    begun = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), none)
    starts = per_block.withColumn("s_in", begun).withColumn("n_in", F.row_number().over(inside) - 1).join(chunks, [*key, "chunk"])
    # a partial epoch is a source's last one, so what is cut off has the last numbers
    numbered = starts.select(*key, "block", (F.col("s_before") + F.col("s_in")).alias("start"), "size", (F.col("n_before") + F.col("n_in")).alias("seq"), "rest")
    numbered = written(numbered.where("rest IS NULL OR start < rest").drop("rest"), "blocks")
    whole = numbered.groupBy("run_name", "source").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"))
    runs: dict[str, tuple[int, dict[str, tuple[int, int]]]] = {}
    tokens: dict[str, int] = {}
    for r in sorted(bounded(whole, MAX_TARGETS, "the drawn sources"), key=str):
        own = runs.setdefault(r["run_name"], (1, {}))[1]
        own[r["source"]] = (len(own), r["n"])
        tokens[r["run_name"]] = tokens.get(r["run_name"], 0) + r["tokens"]
    runs = {k: (max(1, -(-tokens[k] // SHARD_TOKENS)), own) for k, (_, own) in runs.items()}
    placed = written(dealt(numbered, runs, seed), "placed")
    joined = drawn.join(placed, [*key, "block"])
    running = F.sum("tokens").over(Window.partitionBy(*key, "block").orderBy("mark", "doc_id"))
    ends_in = F.col("rest").isNotNull() & (F.col("start") + F.col("size") > F.col("rest"))
    full = joined.where(~ends_in)
    cut = joined.where(ends_in).withColumn("reached", running).where("start + reached - tokens / 2 <= rest").drop("reached")
    taken = full.unionByName(cut)
    place = F.row_number().over(Window.partitionBy("run_name", "shard").orderBy(F.xxhash64("mark", F.lit(seed)), "doc_id", "epoch"))
    sample = taken.select("run_name", "source", "shard", place.alias("place"), "doc_id", F.col("epoch").alias("repeat"), "tokens")
    used = taken.groupBy("run_name", "source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"), (F.max("epoch") + 1).alias("repeats"), F.countDistinct("shard").alias("shards"))
    wanted = spark.createDataFrame([(x["run_name"], x["source"], x["share"], x["wanted"], x["have"], x["docs"]) for x in lines], "run_name string, source string, target_share double, target_tokens bigint, available_tokens bigint, available_docs bigint")
    report = wanted.join(used, ["run_name", "source"], "left").na.fill(0, ["tokens", "docs", "repeats", "shards"])
    all_of_run = F.sum("tokens").over(Window.partitionBy("run_name"))
    report = report.withColumn("actual_share", F.when(all_of_run > 0, F.col("tokens") / all_of_run).otherwise(F.lit(0.0)))
    return sample, report
