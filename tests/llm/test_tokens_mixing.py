import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.llm import mixing, tokens

TEXTS = ["", None, "   ", "Hello  world's it'll\n\n\tend ", "한국어 텍스트 ½ ² x²\u0085y", "a" * 5000, "🙂👩‍🔬 café café <|endoftext|>", "12345 67,8\r\n\x01\x7f", "Hello  world's it'll\n\n\tend ", "  　x"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, word string")


def test_ids_equal_the_tokenizer_and_decode_back(spark):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab '\n\t12가나.é") for _ in range(rng.randint(1, 80))) for _ in range(60)]
    own = tokens._encoder(tokens.tokenizer_file())
    coded = tokens.encode(frame(spark, texts))
    got = {r["doc_id"]: list(r["ids"]) for r in coded.collect()}
    assert got == {i: own.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in tokens.decode(coded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["tokens"] for r in tokens.counts(frame(spark, texts)).collect()} == {i: len(x) for i, x in got.items()}


def test_an_id_that_stands_twice_has_a_row_for_each_of_its_texts(spark):
    df = spark.createDataFrame([(1, "one two two"), (1, "one two two"), (1, "three"), (2, None), (2, ""), (None, "four")], "doc_id bigint, text string")
    own = tokens._encoder(tokens.tokenizer_file()).encode_ordinary
    want = [(1, own("one two two")), (1, own("three")), (2, []), (None, own("four"))]
    assert sorted(map(repr, ((r["doc_id"], list(r["ids"])) for r in tokens.encode(df).collect()))) == sorted(map(repr, want))
    assert sorted(map(repr, ((r["doc_id"], r["tokens"]) for r in tokens.counts(df).collect()))) == sorted(repr((k, len(x))) for k, x in want)


def test_an_empty_table(spark):
    assert tokens.encode(frame(spark, []).limit(0)).count() == 0 and tokens.counts(frame(spark, []).limit(0)).count() == 0


def test_the_splitting_tree_is_exact():
    quotas = [100, 0, 3, 57]
    for leaves in (1, 2, 7, 16):
        tree, again = mixing.Tree(quotas, leaves, (1, 0)), mixing.Tree(quotas, leaves, (1, 0))
        shards = [[tree.shard(s, k) for k in range(q)] for s, q in enumerate(quotas)]
        assert [[again.shard(s, k) for k in reversed(range(q))][::-1] for s, q in enumerate(quotas)] == shards  # in whatever order blocks come
        sums = np.bincount([x for own in shards for x in own], minlength=leaves)
        assert len(sums) == leaves and abs(sums - 160 / leaves).max() <= np.log2(leaves) + 1


def test_thousands_of_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 1)
    monkeypatch.setattr(mixing, "CHUNK", 64)
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 3)
    monkeypatch.setattr(mixing, "NODES", 50)
    sizes = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit(2).cast("bigint").alias("tokens"))
    targets = spark.createDataFrame([("r", "a", 1.0, 1, 0.6), ("r", "b", 2.0, 1, 0.6)], "run_name string, source string, weight double, max_repeat int, size_ratio double")
    sample, report = mixing.mix(sizes, targets)
    rows = sample.collect()
    assert len({r["shard"] for r in rows}) > 1500 and len({r["doc_id"] for r in rows}) == len(rows) == 3600
    assert {r["source"]: r["tokens"] for r in report.collect()} == {"a": 2400, "b": 4800}


@pytest.fixture
def mixed(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    monkeypatch.setattr(mixing, "CHUNK", 8)
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 2000)
    rows = [(i, "big" if i < 900 else "small" if i < 960 else None if i < 970 else "empty", 0 if i >= 970 else 1 + i % 19) for i in range(980)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("r", "big", 1.0, 1, 0.5), ("r", "big", 1.0, 1, 0.5), ("r", "small", 3.0, 4, 0.5), ("r", "none", 1.0, 2, 0.5), ("r", "empty", None, None, 0.5), ("s", "big", 0.5, 3, 2.0)], "run_name string, source string, weight double, max_repeat int, size_ratio double")
    sample, report = mixing.mix(sizes, targets)
    return {i: (s, t) for i, s, t in rows}, sample.collect(), {(r["run_name"], r["source"]): r for r in report.collect()}


def test_shares_repeats_and_places(mixed):
    docs, sample, report = mixed
    total = sum(t for _, t in docs.values())
    big, small = (sum(t for s, t in docs.values() if s == k) for k in ("big", "small"))
    assert len(report) == 5 and report["r", "none"]["tokens"] == report["r", "empty"]["tokens"] == 0
    assert report["r", "small"]["tokens"] == 4 * small and report["r", "small"]["repeats"] == 4  # capped
    assert abs(report["r", "big"]["tokens"] - 0.2 * 0.5 * total) <= 20
    assert report["s", "big"]["tokens"] == pytest.approx(min(2 * total, 3 * big), abs=20) and report["s", "big"]["actual_share"] == 1
    used = {}
    for r in sample:
        used.setdefault((r["run_name"], r["doc_id"]), []).append(r["repeat"])
        assert docs[r["doc_id"]] == (r["source"], r["tokens"])
    assert all(len(x) == len(set(x)) for x in used.values())  # each document once in an epoch
    for key in {(r["run_name"], r["shard"]) for r in sample}:
        places = sorted(r["place"] for r in sample if (r["run_name"], r["shard"]) == key)
        assert places == list(range(1, len(places) + 1))
    assert report["s", "big"]["shards"] > 3


def test_no_documents(spark):
    sizes = spark.createDataFrame([], "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("r", "a", 1.0, 1, 1.0)], "run_name string, source string, weight double, max_repeat int, size_ratio double")
    sample, report = mixing.mix(sizes, targets)
    assert sample.count() == 0 and report.select(F.sum("tokens")).first()[0] == 0
