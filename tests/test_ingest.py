import json

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators.deadletter import split_valid
from fleetlens.sources import derived, feed, positions, producer
from tests.conftest import SMALL, rows_of

LINE = {"c": "627J-10", "cl": 1, "sl": 2, "lt0": "T", "lt1": "O", "qv": 2}
VEHICLE = {"p": 11, "a": True, "ta": "2024-03-01T11:00:00Z", "py": -23.5, "px": -46.6}


def payloads(spark, *bodies):
    texts = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return spark.createDataFrame(texts, "payload string")


def test_flatten_repeats_line_fields(spark):
    body = {"l": [{**LINE, "vs": [VEHICLE, {**VEHICLE, "p": 12, "ta": "2024-03-01T02:59:59.900Z"}]}]}
    first, second = feed.flatten_feed(payloads(spark, body)).orderBy("p").collect()
    assert (first.c, first.p, first.ta, first.ta_tempo) == ("627J-10", 11, 1709290800000, "2024-03-01 08:00:00")
    assert (second.ta, second.ta_tempo) == (1709261999900, "2024-02-29 23:59:59")


@pytest.mark.parametrize("body", [{"l": []}, {"l": [{**LINE, "vs": []}]}, {}, "null", "", " [] ", "false"])
def test_empty_payloads_give_no_rows(spark, body):
    assert feed.flatten_feed(payloads(spark, body)).count() == 0
    assert feed.checked_rows(payloads(spark, body)).count() == 0


def test_unreadable_payloads_become_dead_letters(spark):
    good = {"l": [{**LINE, "vs": [VEHICLE]}]}
    broken = ["not json", '{"l":[{"c":"A","vs":[{"p":1', '{"l":[{"c":"A","vs":{"p":1}}]}', '{"l":"x"}', "<html></html>"]
    rows, dead = feed.flatten_checked(payloads(spark, good, *broken, "", "null"))
    assert rows.count() == 1
    assert sorted((r.key, r.value) for r in dead.collect()) == sorted(("unknown", b) for b in broken)
    assert rows_of(feed.dead_payloads(payloads(spark, good, *broken))) == rows_of(dead)


def test_bad_vehicles_become_dead_letters(spark):
    vehicles = [
        VEHICLE, {**VEHICLE, "p": "x1"}, {k: v for k, v in VEHICLE.items() if k != "p"}, {**VEHICLE, "ta": "soon"},
        {**VEHICLE, "py": "north"}, {**VEHICLE, "p": 99999999999},
    ]
    good, dead = feed.flatten_checked(payloads(spark, {"l": [{**LINE, "vs": vehicles}]}))
    assert [(r.p, r.a, r.py) for r in good.collect()] == [(11, True, -23.5)]
    letters = [(r.key, json.loads(r.value)) for r in dead.collect()]
    assert sorted(k for k, _ in letters) == ["11", "11", "99999999999", "unknown", "x1"]
    assert {v["ta"] for k, v in letters} >= {"soon"} and all(set(v) == set(schemas.REPORT.names) for _, v in letters)


def test_flags_are_parsed(spark):
    raw = derived.raw_reports(spark, SMALL)
    good, dead = split_valid(raw.withColumn("a", F.lit("false")))
    assert good.where("a").count() == 0 and good.count() + dead.count() == raw.count()


def test_missing_text_is_a_dead_letter(spark):
    raw = derived.raw_reports(spark, SMALL).withColumn("lt1", F.lit(None).cast("string"))
    good, dead = split_valid(raw)
    assert good.count() == 0 and dead.count() == raw.count()


def test_kafka_records_decode(spark):
    reports = derived.positions(spark, SMALL)
    framed = producer.to_messages(reports).select(
        "key", F.col("value").cast("binary").alias("value"), F.lit(3).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
    )
    decoded = positions.decode_messages(framed, "json")
    assert decoded.columns == schemas.POSITIONS.names
    assert rows_of(decoded.select(*schemas.REPORT.names)) == rows_of(reports.select(*schemas.REPORT.names))
    assert decoded.where(F.shiftright("event_id", 48) != 3).count() == 0


def test_landing_keeps_a_vehicle_in_one_partition(spark, tmp_path):
    good, dead = split_valid(derived.raw_reports(spark, SMALL))
    producer.land(producer.tagged(good, dead), str(tmp_path), 4)
    landed = spark.read.json(str(tmp_path)).withColumn("file", F.input_file_name())
    assert landed.where(F.col("topic") == producer.DEAD_LETTER_TOPIC).count() == dead.count()
    landed = landed.where(F.col("topic") == positions.TOPIC)
    assert landed.count() == good.count()
    assert landed.groupBy("key").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0
    assert landed.select("file").distinct().count() <= 4


def test_ingest_job_over_batches(spark, tmp_path):
    folder = tmp_path / "polls"
    folder.mkdir()
    texts = []
    for i in range(4):
        vehicle = {"p": i, "a": False, "ta": "2024-03-01T11:00:00Z" if i else "soon", "py": 1.0, "px": 2.0}
        texts.append(json.dumps({"l": [{**LINE, "vs": [vehicle]}]}))
    for i, text in enumerate([*texts, "<html>", '{"l":[{', ""]):
        (folder / f"{i}.json").write_text(text)
    source = feed.read_payload_stream(spark, str(folder), files_per_batch=2)
    query = producer.start_ingest(source, str(tmp_path / "c"), str(tmp_path / "out"), trigger=(("availableNow", True),))
    query.awaitTermination()
    landed = [(r.topic, r.key) for r in spark.read.json(str(tmp_path / "out")).collect()]
    dead = producer.DEAD_LETTER_TOPIC
    assert sorted(landed) == sorted([(positions.TOPIC, k) for k in "123"] + [(dead, "0"), (dead, "unknown"), (dead, "unknown")])



@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_positions_read_back_from_files(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = derived.positions(spark, SMALL)
    writer = df.write.format(fmt)
    if fmt in ("csv", "json"):
        writer = writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    writer.save(path)
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"} if fmt in ("csv", "json") else {}
    assert rows_of(positions.read_positions(spark, fmt, path, **options)) == rows_of(df)


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        positions.read_positions(spark, "xml", "/tmp/none")


def test_gtfs_csv(spark, tmp_path):
    (tmp_path / "shapes.txt").write_text("shape_id,shape_pt_lat,shape_pt_lon,shape_dist_traveled\nS1,-23.5,-46.6,10.5\n")
    (tmp_path / "trips.txt").write_text("route_id,shape_id,direction_id\nA,S1,0\n")
    assert tuple(positions.read_shapes(spark, str(tmp_path / "shapes.txt")).first()) == ("S1", -23.5, -46.6, 10.5)
    assert tuple(positions.read_trips(spark, str(tmp_path / "trips.txt")).first()) == ("A", "S1", 0)


def test_avro_schema_lists_the_wire_fields():
    schema = json.loads(schemas.avro_schema())
    assert [f["name"] for f in schema["fields"]] == schemas.REPORT.names
    assert {f["name"]: f["type"] for f in schema["fields"]}["ta"] == "long"
