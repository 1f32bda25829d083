import json

from pyspark.sql import functions as F

from inkmill.streaming import flows


def test_jobs_once_each_over_two_runs(spark, tmp_path):
    jobs, out = tmp_path / "jobs", str(tmp_path / "out")
    jobs.mkdir()

    def put(name, **k):
        (jobs / name).write_text(json.dumps(k))

    def run():
        flows.drained(flows.once(flows.jobs(spark, str(jobs)), ["id"]), str(tmp_path / "check"), lambda b, n: b.write.mode("append").parquet(out))

    put("a.json", id="1", question="q")
    put("b.json", id="2", question="  ")
    run()
    put("c.json", id="1", question="again")
    put("d.json", id="3", question="q3")
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["1", "3"]


def test_outbox_tries_twice(spark, tmp_path):
    tries = []

    def send(rows):
        tries.append(1)
        return rows.select("id", (F.col("id") == "good").alias("sent") if len(tries) == 1 else (F.col("id") == "late").alias("sent"))

    flows.outbox(str(tmp_path), send)(spark.createDataFrame([("good",), ("late",), ("bad",)], "id string"), 0)
    assert {r["id"]: r["state"] for r in spark.read.parquet(str(tmp_path / "state")).collect()} == {"good": "sent", "late": "sent", "bad": "unsent"}


def test_retry_state_and_its_table_form(spark, tmp_path):
    rows = [("x", "failed", 1), ("y", "failed", 1), ("x", "failed", 2), ("y", "done", 2), ("y", "failed", 3), ("z", "failed", 1), ("z", "gone", 2)]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "item string, outcome string, at int"
    spark.createDataFrame(rows[:2], schema).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)

    def run():
        q = flows.retries(stream).writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("append").parquet(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    spark.createDataFrame(rows[2:], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    last = {(r["item"], r["fails"], r["given_up"]) for r in spark.read.parquet(out).collect()}
    assert {("x", 2, True), ("y", 1, False), ("z", 0, False)} <= last
    got = {r["item"]: (r["fails"], r["given_up"]) for r in flows.retry_counts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"x": (2, True), "y": (1, False)}
