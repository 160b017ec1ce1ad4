"""Files in and out, and streams against batch."""

import json
import time

import pandas as pd
from pyspark.sql import functions as F
from test_corpus import document

from flowspark.catalog import requests as B
from flowspark.catalog import streams as ST
from flowspark.operators import corpus as C
from flowspark.operators import ordered as O
from flowspark.operators import requests as R
from flowspark.sources import audit as A
from flowspark.sources import flows as S
from flowspark.sources.metadata import read_metadata
from flowspark.streaming import log as L
from flowspark.streaming import stateful as P


def put(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_flows_round_trip(spark, folder):
    put(folder, "a.json", json.dumps({**document(), "name": "My flow/x"}, indent=2))
    put(folder, "b.json", "{")
    read = S.read_flows(spark, folder)
    assert {r.path.rsplit("/", 1)[1]: r.status for r in read.collect()} == {"a.json": "ok", "b.json": "no_json"}
    for file_per_flow in (False, True):
        out = f"{folder}/out{file_per_flow}"
        S.write_flows(read.filter("status = 'ok'"), out, file_per_flow=file_per_flow)
        back = S.read_written(spark, out).first()
        assert back.safe_name == "My_flow_x_flow" and back.name == "My flow/x"
        assert back.steps[0].createdDate["$date"] == "2026-05-15T01:44:25.911Z"


def test_flows_written_again_replace_themselves(spark, folder):
    docs = [{**document(), "name": n} for n in ("One", "Two")]
    rows = C.parse_flows(spark.createDataFrame([(json.dumps(d), f"about {d['name']}") for d in docs], "response STRING, asked STRING"))
    for file_per_flow in (False, True):
        out = f"{folder}/{file_per_flow}"
        for _ in range(2):
            S.write_flows(rows, out, description="asked", file_per_flow=file_per_flow)
        other = rows.filter("document.name = 'Two'")
        S.write_flows(other, out, description="asked", file_per_flow=file_per_flow, batch="more")
        found = [(r.name, r.business_description) for r in S.read_written(spark, out).collect()]
        assert sorted(found) == [("One", "about One")] + [("Two", "about Two")] * (1 if file_per_flow else 2)


def test_stream_step_obeys_the_write_mode(spark, folder):
    schema = "tie long, key string"
    stream = put_files(spark, f"{folder}/in", [[(1, "a"), (2, "b")], [(3, "c")]], schema)
    for mode, want in (("APPEND", [1, 2, 3]), ("REPLACE", [3])):
        L.write_stream_step(stream, mode, folder, mode, mode).awaitTermination()
        assert sorted(r.tie for r in spark.read.parquet(f"{folder}/{mode}").collect()) == want


def test_descriptions(spark, folder):
    put(folder, "d.txt", "first\n\n  # note\r\n  second  \n# other\nthird")
    rows = S.read_descriptions(spark, f"{folder}/d.txt").orderBy("line_no").collect()
    assert [r.description for r in rows] == ["first", "second", "third"]
    put(folder, "many.txt", "\n".join(f"line {i}" for i in range(150)))
    assert S.read_descriptions(spark, f"{folder}/many.txt").count() == 150
    first = S.read_descriptions(spark, [f"{folder}/many.txt", f"{folder}/d.txt"], 100).groupBy("path").count().collect()
    assert sorted(r["count"] for r in first) == [len(rows), 100]


def test_metadata_by_file_ending(spark, folder):
    put(folder, "a.json", '{"tables": [{"name": "t"}]}')
    put(folder, "b.ddl", "CREATE TABLE t (a INT)")
    put(folder, "c.sql", "CREATE TABLE t (a INT); CREATE TABLE u (a INT)")
    put(folder, "d.txt", '[{"name": "t"}]')
    put(folder, "e.txt", "CREATE TABLE t (a INT)")
    put(folder, "f.txt", "neither")
    put(folder, "g.json", "CREATE TABLE t (a INT)")
    got = {r.path.rsplit("/", 1)[1]: (r.tables is not None and len(r.tables), r.error is None) for r in read_metadata(spark, folder).collect()}
    assert got == {"a.json": (1, True), "b.ddl": (1, True), "c.sql": (2, True), "d.txt": (1, True), "e.txt": (1, True), "f.txt": (False, False), "g.json": (False, False)}


def test_audit_round_trip(spark, folder):
    df = spark.createDataFrame([("2026-01-01T00:00:00+00:00", None, "p", "m/x", "success", 0.0123456)], "t STRING, c STRING, p STRING, m STRING, s STRING, x DOUBLE")
    line = A.audit_line(*[F.col(c) for c in "tcpmsx"])
    for _ in range(2):
        A.write_audit(df.select(line), f"{folder}/log")
    rows = A.read_audit(spark, f"{folder}/log").collect()
    assert len(rows) == 2 and rows[0].value == "2026-01-01T00:00:00+00:00 | - | p/m/x | success | cost=$0.012346"
    assert (rows[0].client, rows[0].provider, rows[0].model, rows[0].status, rows[0].cost) == ("-", "p", "m/x", "success", 0.012346)


def test_queue_source_uses_the_group_of_the_step(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **kv):
            seen.update(kv)
            return self

        def option(self, k, v):
            seen[k] = v
            return self

    monkeypatch.setattr(type(spark), "readStream", property(lambda self: Reader()))
    L.stream_source(spark, {"output": {"kafkaGroup": "g1"}}, {"subscribe": "topic"})
    assert seen == {"format": "kafka", "subscribe": "topic", "kafka.group.id": "g1"}


def test_streams_over_several_batches_equal_batch(spark, sf, folder):
    """Four files in time order, one per micro-batch."""
    calls = B.log(spark, sf).select("event_id", "provider", "request_key", "t_us", "status")
    low, high = calls.agg(F.min("t_us"), F.max("t_us")).first()
    for i in range(4):
        a, b = low + (high - low) * i // 4, low + (high - low) * (i + 1) // 4
        part = calls.filter((F.col("t_us") > a if i else F.col("t_us") >= a) & (F.col("t_us") <= b))
        part.coalesce(1).write.parquet(f"{folder}/in/part={i}")
        time.sleep(0.05)
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    rpm = R.rpm_limit("provider", {"click": 5, "error": 20}, 3)
    got = L.run_available(L.stream_throttle(stream, "provider", "t_us", "event_id", rpm), "t", f"{folder}/t")
    want = O.throttle(calls, "provider", "t_us", "event_id", rpm, 60).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    fills = F.col("status") == "success"
    got = L.run_available(L.stream_ttl_dedup(stream, "request_key", "t_us", "event_id", fills, 60), "d", f"{folder}/d")
    want = O.ttl_dedup(calls, "request_key", "t_us", "event_id", fills, 60, 60).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert len(list(spark.read.parquet(f"{folder}/t").inputFiles())) >= 4


def put_files(spark, folder, files, schema):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={i}")
        time.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")


CALL = "tie long, key string, t_us long, ok boolean"
MINUTE = 60_000_000


def test_late_requests_are_judged_by_the_answers_of_their_time(spark, folder):
    """Answers hold for 300 minutes; the last files are hours behind the others."""
    files = [
        [(1, "a", 600), (2, "b", 600)], [(3, "a", 899), (4, "a", 901)], [(5, "a", 1500)],
        [(6, "a", 599), (7, "a", 650), (8, "a", 1201), (9, "a", 1202), (10, "c", 10), (11, "b", 11), (12, "b", 12)],
    ]
    rows = [[(tie, key, m * MINUTE, True) for tie, key, m in f] for f in files]
    stream = put_files(spark, f"{folder}/in", rows, CALL)
    out = L.stream_ttl_dedup(stream, "key", "t_us", "tie", F.col("ok"), 300 * 60, 2000 * 60)
    got = {r["tie"]: r["hit"] for r in L.run_available(out, "d", f"{folder}/d").collect()}
    assert got == {
        1: False, 2: False, 3: True, 4: False, 5: False,
        6: False,  # before any answer was made, hours later or not
        7: True, 8: True,  # by the answers of 600 and 901
        9: False, 10: False, 11: False, 12: True,
    }


def test_state_of_an_idle_key_ends(spark, folder):
    schema = CALL.replace("ok boolean", "rpm int")
    first = [(1, "a", 0, 1), (2, "none", 0, None)]
    stream = put_files(spark, f"{folder}/in", [first], schema)
    throttled = L.stream_throttle(stream, "key", "t_us", "tie", F.col("rpm"), keep_seconds=2)
    held = L.stream_ttl_dedup(stream.withColumn("ok", F.lit(True)), "key", "t_us", "tie", F.col("ok"), 300, keep_seconds=2)
    for name, out in (("t", throttled), ("d", held)):
        L.run_available(out, name, f"{folder}/{name}")
    time.sleep(3)
    put_files(spark, f"{folder}/more", [[(3, "a", 1, 1)]], schema)
    spark.read.parquet(f"{folder}/more/part=0").coalesce(1).write.parquet(f"{folder}/in/part=9")
    got = {r["tie"]: (r["allowed"], r["retry_after"]) for r in L.run_available(throttled, "t", f"{folder}/t").collect()}
    assert got == {1: (True, 0.0), 2: (False, None), 3: (True, 0.0)}
    assert {r["tie"]: r["hit"] for r in L.run_available(held, "d", f"{folder}/d").collect()} == {1: False, 2: False, 3: False}


def test_hot_key_in_chunks(monkeypatch):
    """One key's chunks come in any order and leave in chunks; rows equal to the batch rule."""
    monkeypatch.setattr(P, "CHUNK", 7)
    times = [(37 * k) % 500 * 1_000_000 for k in range(500)]
    rows = [pd.DataFrame({"t_us": times[a : a + 90], "tie": range(a, min(a + 90, 500)), "fills": True, "ttl": 20_000_000, "rpm": 3}) for a in range(0, 500, 90)]
    order = sorted(range(500), key=lambda k: (times[k], k))

    class Value(dict):
        exists, get = (lambda self: "v" in self), (lambda self: self["v"])
        update = lambda self, v: self.__setitem__("v", v)
        iterator = lambda self: (((k,), (v,)) for k, v in self.items())
        updateValue = lambda self, k, v: self.__setitem__(k[0], v[0])
        removeKey = lambda self, k: self.__delitem__(k[0])

    answers, bucket = P.Answers(0, 0), P.TokenBucket(0)
    answers.answers, bucket.full_at = Value(), Value()
    hits = list(answers.handleInputRows(("k",), iter(rows), None))
    allowed = list(bucket.handleInputRows(("k",), iter(rows), None))
    assert len(hits) == len(allowed) == -(-500 // 7)
    ordered = [times[k] for k in order]
    assert pd.concat(hits)["hit"].tolist() == O.ttl_run(ordered, [True] * 500, [20_000_000] * 500, None)[0]
    assert pd.concat(allowed)["allowed"].tolist() == O.bucket_run(ordered, 3, None)[0]
    assert len(answers.answers) == 1


def test_minutes_and_late_rows_add_up_to_the_batch(spark, folder):
    files = [[(k, "p", (100 + k) * MINUTE, k) for k in range(5)], [(9, "p", 103 * MINUTE, 7)], [(10, "p", 60 * MINUTE, 1), (11, "q", 90 * MINUTE, 2), (12, "p", None, 3)]]
    schema = "tie long, provider string, t_us long, tokens int"
    stream = put_files(spark, f"{folder}/in", files, schema)
    sums = {"tokens": F.col("tokens")}
    L.write_per_minute(stream, f"{folder}/out", "m", "t_us", ["provider"], sums, delay_seconds=600).awaitTermination()
    late = spark.read.parquet(f"{folder}/out/late")
    assert sorted(r.tie for r in late.collect()) == [10, 11]
    whole = spark.createDataFrame([r for f in files for r in f], schema)
    want = L.minute_sums(whole, "t_us", ["provider"], sums)
    got = L.read_per_minute(spark, f"{folder}/out", "t_us", ["provider"], sums).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert L.read_per_minute(spark, f"{folder}/out", "t_us", ["provider"], sums, late=False).count() == want.count() - 2


def test_stream_flow_batches_may_repeat(spark, sf):
    assert ST.stream_flow(spark, sf).count() > 0


def test_long_session_stays_whole(spark):
    items = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("started_at"), F.col("id").cast("string").alias("id"),
        F.repeat(F.lit("x"), F.lit(100)).alias("description"), F.lit("p").alias("provider"),
        F.when(F.col("id") % 2 == 0, "success").otherwise("failed").alias("status"), F.lit(None).cast("string").alias("path"),
        F.col("id").alias("timestamp"),
    )
    rows = S.session_history(items).collect()
    assert {(r.started_at, r.flow_count, r.success_count) for r in rows} == {("hot", 666, 333), ("cold", 334, 167)}
    assert len(rows) == 1000 and all(len(r.description) == 100 and len(r.description_short) == 80 for r in rows)
    assert {r.started_at for r in S.recent_sessions(S.session_history(items), 1).collect()} == {"hot"}
