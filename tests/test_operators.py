import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions import display
from fleetlens.operators import constraints, lag, nearest, upsert
from fleetlens.operators.latest import newest_by_state, newest_rows
from fleetlens.plans import fleet, headway, motion, routes
from fleetlens.sources import derived
from tests.conftest import SMALL, rows_of


@pytest.fixture(scope="module")
def positions(spark):
    return derived.positions(spark, SMALL)


def cuts_of(df, column, rows_per_chunk):
    """Edges for all rows, as if they had one key."""
    return lag.order_splits(df.withColumn("one", F.lit(1)), column, [["one"]], rows_per_chunk)


def test_few_rows_need_no_splits(positions):
    assert lag.order_splits(positions, "event_time", [["p"], ["c", "sl"]]) == ()


def test_splits_bound_the_chunks(positions):
    cuts = cuts_of(positions, "event_time", 100)
    sizes = [r["count"] for r in lag.with_chunk(positions, "event_time", cuts).groupBy(lag.CHUNK).count().collect()]
    assert len(cuts) == 9 and len(sizes) == 10 and max(sizes) <= 150


def test_sampled_splits_bound_the_chunks(spark):
    skewed = spark.range(200_000).selectExpr("cast(pow(id, 3) AS double) AS t")
    cuts = cuts_of(skewed, "t", 10_000)
    sizes = [r["count"] for r in lag.with_chunk(skewed, "t", cuts).groupBy(lag.CHUNK).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 20_000


@pytest.mark.parametrize("rows_per_chunk", [400, 40, 7])
def test_chunked_plans_equal_plain_ones(positions, rows_per_chunk):
    cuts = cuts_of(positions, "event_time", rows_per_chunk)
    assert cuts
    for plan in (motion.speed_history, headway.headway_events, fleet.vehicle_status, headway.motion_with_gaps):
        assert rows_of(plan(positions, cuts)) == rows_of(plan(positions, ()))


def test_chunked_lag_with_one_hot_key_gaps_and_null_keys(spark):
    rng = random.Random(3)
    rows = [(("hot" if i % 3 else rng.choice(["a", "b", None])), float(rng.choice(range(0, 5000, 10))), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t double, id long")
    plain = lag.lag_over(df, ["k"], ["t", "id"], {"prev": "id"}).drop(lag.CHUNK)
    cuts = lag.order_splits(df, "t", [["k"]], 50)
    assert len(cuts) > 10
    assert rows_of(lag.lag_over(df, ["k"], ["t", "id"], {"prev": "id"}, cuts).drop(lag.CHUNK)) == rows_of(plain)


def test_chunked_lag_shuffles_the_rows_once(positions):
    cuts = cuts_of(positions, "event_time", 100)
    rows = motion.with_previous_fix(positions, cuts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # One exchange for the rows and seeds, two for the seeds: one per (key, chunk), one per key.
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def test_latest_is_cut_before_the_shuffle(positions):
    plan = fleet.latest_position(positions)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def test_newest_rows_equal_newest_by_state(positions):
    rows = fleet.as_position_rows(positions)
    order = ["ultima_atualizacao", "event_id"]
    by_window, by_state = newest_rows(rows, ["prefixo"], order), newest_by_state(rows, ["prefixo"], order)
    assert rows_of(by_window) == rows_of(by_state.select(*by_window.columns))


def brute_nearest(left, points, radius):
    best = {}
    for key, lat, lon in left:
        found = [
            ((plat - lat) * (plat - lat) + (plon - lon) * (plon - lon), value)
            for plat, plon, value in points
            if lat - radius <= plat <= lat + radius and lon - radius <= plon <= lon + radius
        ]
        best[key] = min(found)[1] if found else None
    return best


@pytest.mark.parametrize("levels", [None, 1, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_equals_brute_force(spark, seed, levels):
    rng = random.Random(seed)
    radius = 0.01
    centre = [(0.0, 0.0), (-23.5, -46.6), (0.004, -0.004)]
    crowded = [(lat + rng.gauss(0, 2e-5), lon + rng.gauss(0, 2e-5)) for lat, lon in centre for _ in range(60)]
    spread = [(rng.uniform(-0.03, 0.03), rng.uniform(-0.03, 0.03)) for _ in range(80)]
    copies = [spread[0]] * 20
    points = [(lat, lon, float(i)) for i, (lat, lon) in enumerate(crowded + spread + copies)]
    spots = [(rng.uniform(-0.04, 0.04), rng.uniform(-0.04, 0.04)) for _ in range(80)]
    spots += [(lat + radius, lon - radius) for lat, lon in spread[:15]] + spread[:5] + crowded[:5] + [(50.0, 50.0)]
    left = [(i, lat, lon) for i, (lat, lon) in enumerate(spots)]
    result = nearest.nearest_point(
        spark.createDataFrame([*left, (999, None, 1.0)], "k int, la double, lo double"),
        spark.createDataFrame([*points, (None, 0.0, 5.0)], "a double, b double, v double"),
        ["la", "lo"], ["a", "b"], "v", radius, levels,
    )
    assert {r.k: r.v for r in result.collect()} == {**brute_nearest(left, points, radius), 999: None}


def test_nearest_levels_grow_with_points():
    assert [nearest.levels_for(n) for n in (0, 64, 10_000, 1_000_000, 10**9)] == [1, 1, 2, 3, 4]


def test_unplaced_vehicle_leaves_the_spacing(spark):
    latest = spark.createDataFrame(
        [(1, "A", -23.5, -46.6), (2, "A", -23.5, -46.601), (3, "A", 10.0, 10.0)],
        "prefixo int, linha string, latitude double, longitude double",
    )
    shapes = spark.createDataFrame(
        [("S", -23.5, -46.6, 1000.0), ("S", -23.5, -46.601, 1150.0)],
        "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_dist_traveled double",
    )
    placed = {r.prefixo: r.dist_percorrida_metros for r in routes.place_on_shapes(latest, shapes).collect()}
    assert placed == {1: 1000.0, 2: 1150.0, 3: None}
    row, = routes.route_spacing(latest, shapes).collect()
    assert (row.onibus, row.onibus_a_frente, row.km_acumulado_rota, row.dist_entre_onibus_km) == (2, 1, "1150,0", "0,15")
    assert row.diagnostico_operacional == display.BUNCHED


def test_spacing_is_the_same_in_chunks(spark, positions):
    latest = fleet.latest_position(positions).checkpoint()
    shapes = derived.shapes(spark, SMALL)
    assert routes.route_spacing(latest, shapes).collect() == routes.route_spacing(latest, shapes, 3).collect()


@pytest.mark.parametrize("gap,text", [(0.2, display.BUNCHED), (0.21, display.REGULAR), (3.0, display.WIDE),
                                      (4.99, display.WIDE), (5.0, display.SERVICE_GAP), (None, display.REGULAR)])
def test_diagnosis(spark, gap, text):
    assert spark.range(1).select(display.spacing_diagnosis(F.lit(gap).cast("double"))).first()[0] == text


@pytest.mark.parametrize("minutes,text", [(9.72, "09:43"), (65.5, "05:30"), (0.0, "00:00"), (7.5, "07:30"), (120.0, "00:00")])
def test_minute_clock(spark, minutes, text):
    assert spark.range(1).select(display.minute_clock(F.lit(minutes))).first()[0] == text


@pytest.mark.parametrize("value,places,text", [(12.345, 2, "12,35"), (5.0, 1, "5,0"), (-0.125, 2, "-0,13"), (None, 1, None)])
def test_decimal_comma(spark, value, places, text):
    assert spark.range(1).select(display.decimal_comma(F.lit(value).cast("double"), places)).first()[0] == text


def test_route_length_takes_the_longest_shape_and_fills_a_missing_direction(spark):
    shapes = spark.createDataFrame(
        [("S1", 0.0, 0.0, 1000.0), ("S1", 0.0, 0.0, 2500.0), ("S2", 0.0, 0.0, 9000.0), ("S3", 0.0, 0.0, 400.0)],
        schemas.SHAPES,
    )
    trips = spark.createDataFrame([("A", "S1", 0), ("A", "S2", 0), ("A", "S2", 0), ("B", "S3", 1), ("B", "S1", 0)], schemas.TRIPS)
    assert [tuple(r) for r in routes.route_length(shapes, trips).collect()] == [
        ("A", "9,00 km", "0,00 km", "9,00 km"), ("B", "2,50 km", "0,40 km", "2,90 km")
    ]


def test_constraints_split_rows(spark):
    spec = schemas.LINE_CATALOGUE
    rows = [("A", None, "T", "text", None), ("B" * 51, "O", "T", None, None)]
    good, bad = constraints.check_constraints(spark.createDataFrame(rows, spec.schema), spec)
    assert good.count() == 0
    assert [sorted(r.broken) for r in bad.orderBy("linha").collect()] == [
        ["not_null:ultima_atualizacao"], ["max_length:linha", "not_null:linha_descricao", "not_null:ultima_atualizacao"]
    ]


def test_merge_is_idempotent_and_keeps_the_newest(spark, positions):
    spec = schemas.LATEST_POSITION
    table = fleet.latest_position(positions)
    once = upsert.merge_latest(table.limit(5), table, spec.keys, spec.updated)
    assert rows_of(once) == rows_of(table)
    assert rows_of(upsert.merge_latest(once, table, spec.keys, spec.updated)) == rows_of(table)


def test_versions_survive_a_repeated_batch(spark, tmp_path):
    spec, path = schemas.ACTIVE_VEHICLES, str(tmp_path / "t")

    def batch(*rows):
        return spark.createDataFrame([], spec.schema) if not rows else spark.createDataFrame(rows, "linha string, total_onibus_ativos long, ultima_atualizacao string").withColumn(
            "ultima_atualizacao", F.to_timestamp("ultima_atualizacao"))

    once, other = (lambda n: upsert.BatchId("q", n)), (lambda n: upsert.BatchId("r", n))
    upsert.upsert(batch(("A", 1, "2024-01-01 00:00:00"), ("B", 1, "2024-01-01 00:00:00")), once(0), path, spec)
    for _ in range(2):
        upsert.upsert(batch(("A", 2, "2024-01-01 00:01:00"), ("C", 5, "2024-01-01 00:01:00")), once(1), path, spec)
    upsert.upsert(batch(("A", 9, "2023-12-31 00:00:00")), once(2), path, spec)

    def stored():
        return {r.linha: r.total_onibus_ativos for r in upsert.read_table(spark, path, spec.schema).collect()}

    assert stored() == {"A": 2, "B": 1, "C": 5}
    # A query that starts afresh counts its batches from 0 again and still merges on top.
    for _ in range(2):
        upsert.upsert(batch(("B", 7, "2024-01-02 00:00:00")), other(0), path, spec)
    assert stored() == {"A": 2, "B": 7, "C": 5}
    upsert.upsert(batch((None, 3, "2024-01-02 00:00:00"), ("L" * 60, 3, "2024-01-02 00:00:00"), ("D", 4, "2024-01-02 00:00:00")),
                  other(1), path, spec)
    assert stored() == {"A": 2, "B": 7, "C": 5, "D": 4}
    rejects = upsert.read_rejects(spark, path, spec).select(F.explode("broken")).collect()
    assert sorted(r[0] for r in rejects) == ["max_length:linha", "not_null:linha"]


def test_old_versions_are_dropped_by_age_and_the_newest_stay(spark, tmp_path):
    table = spark.createDataFrame([("A", 1)], "linha string, n int")
    for number in range(25):
        upsert.write_version(table, str(tmp_path), upsert.BatchId("old", number), keep_seconds=3600)
    assert len(upsert._versions(spark, str(tmp_path))) == 25
    upsert.write_version(table.withColumn("n", F.lit(2)), str(tmp_path), upsert.BatchId("new", 0), keep_seconds=0)
    left = upsert._versions(spark, str(tmp_path))
    assert left[-1].number == 25 and left[-1].batch == "new_0" and 2 <= len(left) < 25
    assert upsert.read_table(spark, str(tmp_path), table.schema).first().n == 2


def test_history_is_pruned_by_date_and_repeats_overwrite(spark, tmp_path, positions):
    spec, path = schemas.SPEED_HISTORY, str(tmp_path / "h")
    history = motion.speed_history(positions)
    even = F.minute("janela_inicio") % 2 == 0
    for query in ("q", "q", "r"):
        upsert.append_history(history.where(even if query == "q" else ~even), upsert.BatchId(query, 0), path, spec)
    stored = upsert.read_history(spark, path, spec)
    assert rows_of(stored.drop("window_date")) == rows_of(history)
    upsert.compact_history(spark, path, spec, "2100-01-01")
    days = list((tmp_path / "h").glob("window_date=*"))
    assert days and all(len(list(day.glob("batch=*"))) == 1 for day in days)
    stored = upsert.read_history(spark, path, spec)
    assert rows_of(stored.drop("window_date")) == rows_of(history)
    plan = stored.where("window_date = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_history_keeps_the_row_written_last(spark, tmp_path):
    """Two writers of one window: the later row comes back whole, before and after compaction, and stays the last."""
    spec, path = schemas.SPEED_HISTORY, str(tmp_path / "h")

    def append(query, *values):
        rows = spark.createDataFrame([("A", *values)], "linha string, velocidade_media double, velocidade_maxima double, velocidade_minima double")
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        upsert.append_history(rows.withColumns({"janela_inicio": start, "janela_fim": start + F.expr("INTERVAL 1 MINUTE")}),
                              upsert.BatchId(query, 0), path, spec)

    def stored():
        return [(r.velocidade_media, r.velocidade_maxima, r.velocidade_minima) for r in upsert.read_history(spark, path, spec).collect()]

    append("z", 30.0, 50.0, 10.0)
    append("b", 40.0, 45.0, 35.0)
    assert stored() == [(40.0, 45.0, 35.0)]
    upsert.compact_history(spark, path, spec, "2100-01-01")
    assert stored() == [(40.0, 45.0, 35.0)]
    append("a", 20.0, 20.0, 20.0)
    assert stored() == [(20.0, 20.0, 20.0)]


def test_rejects_are_written_only_where_there_are_any(spark, tmp_path):
    spec, path = schemas.ACTIVE_VEHICLES, str(tmp_path / "t")
    good = spark.createDataFrame([("A", 1)], "linha string, total_onibus_ativos long").withColumn("ultima_atualizacao", F.lit("2024-01-01").cast("timestamp"))
    for number in range(3):
        upsert.upsert(good, upsert.BatchId("q", number), path, spec)
    assert not (tmp_path / "t_rejects").exists() and upsert.read_rejects(spark, path, spec).count() == 0
    upsert.upsert(good.withColumn("linha", F.lit(None).cast("string")), upsert.BatchId("q", 3), path, spec)
    assert [(r.broken, r.batch) for r in upsert.read_rejects(spark, path, spec).collect()] == [(["not_null:linha"], "q_3")]


@pytest.mark.parametrize("spec", schemas.TABLES.values(), ids=lambda s: s.name)
def test_conflict_statement_upserts(spec):
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
    columns = ", ".join(f"{f.name} {kinds[f.dataType.simpleString()]}" for f in spec.schema.fields)
    db = duckdb.connect()
    db.execute(f"CREATE TABLE {spec.name} ({columns}, PRIMARY KEY ({', '.join(spec.keys)}))")
    db.execute(f"CREATE TABLE staging ({columns})")

    def value(field, n):
        return {"string": f"'k'" if field.name in spec.keys else f"'v{n}'", "timestamp": f"TIMESTAMP '2024-01-0{1 if field.name in spec.keys else n} 00:00:00'",
                "boolean": "true"}.get(field.dataType.simpleString(), "7" if field.name in spec.keys else str(n))

    def stage(n):
        db.execute(f"INSERT INTO staging VALUES ({', '.join(value(f, n) for f in spec.schema.fields)})")

    stage(1)
    db.execute(upsert.conflict_sql(spec, "staging"))
    db.execute("DELETE FROM staging")
    stage(2)
    db.execute(upsert.conflict_sql(spec, "staging"))
    changed = next(c for c in spec.columns if c not in spec.keys and c not in (spec.updated, "acessivel"))
    rows = db.execute(f"SELECT count(*), max(CAST({changed} AS VARCHAR)) FROM {spec.name}").fetchall()
    assert rows[0][0] == 1 and "2" in rows[0][1]
    if spec.updated not in spec.keys:
        db.execute("DELETE FROM staging")
        stage(1)
        db.execute(upsert.conflict_sql(spec, "staging"))
        assert db.execute(f"SELECT max(CAST({changed} AS VARCHAR)) FROM {spec.name}").fetchall() == [(rows[0][1],)]


def test_display_rounds_once(spark):
    values = [0.2049999999, 2.9949999999, 4.9949999999, 0.205, 2.995, 1.25]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        display.fixed(F.col("v"), 2).cast("string").alias("t"), display.spacing_diagnosis(display.fixed(F.col("v"), 2)).alias("d"))
    got = rows.collect()
    assert [r.t for r in got] == ["0.20", "2.99", "4.99", "0.21", "3.00", "1.25"]
    assert [r.d for r in got] == [display.BUNCHED, display.REGULAR, display.WIDE, display.REGULAR, display.WIDE, display.REGULAR]


def test_lookups_on_stored_tables_reach_the_files(spark, tmp_path, positions):
    spec, path = schemas.SPEED_BY_LINE, str(tmp_path / "s")
    upsert.upsert(motion.speed_by_line(positions), upsert.BatchId("q", 0), path, spec)
    found = routes.rows_of_line(upsert.read_table(spark, path, spec.schema), "L01-10")
    assert "EqualTo(linha,L01-10)" in found._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found) == rows_of(routes.rows_of_line(motion.speed_by_line(positions), "L01-10"))
    spec, path = schemas.SPEED_HISTORY, str(tmp_path / "h")
    upsert.append_history(motion.speed_history(positions), upsert.BatchId("q", 0), path, spec)
    newest = routes.history_of_line(upsert.read_history(spark, path, spec), "L01-10").where("window_date = date'2024-01-01'")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(linha,L01-10)" in plan and "PartitionFilters: [isnotnull(window_date" in plan


def test_chunks_are_made_only_for_large_keys(spark, positions):
    assert motion.time_splits(positions, motion.VEHICLE, motion.LINE_WAY) == ()
    per_line = positions.groupBy("c", "sl").count().agg(F.max("count")).first()[0]
    splits = motion.time_splits(positions, motion.LINE_WAY, rows_per_chunk=per_line // 3)
    assert 2 <= len(splits) <= 6
    plan = headway.with_neighbour(positions, splits)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "_seed" in plan


def test_points_are_scanned_twice_at_any_depth(spark):
    shapes = derived.shapes(spark, SMALL)
    spots = spark.createDataFrame([(1, -23.549, -46.629)], "id int, a double, b double")
    for levels in (1, 3, 6):
        found = nearest.nearest_point(spots, shapes, ["a", "b"], ["shape_pt_lat", "shape_pt_lon"], "shape_dist_traveled", 0.01, levels)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan
