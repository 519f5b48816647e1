"""The rules that are easy to get wrong, each on a few hand-made reports."""

import math

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_km
from fleetlens.plans import fleet, headway, motion
from tests.conftest import rows_of


def status_of(df):
    return {r.prefixo: r for r in fleet.vehicle_status(df).collect()}


def test_first_fix_has_no_speed_and_counts_as_stopped(reports):
    df = reports([{"p": 1, "at": 0}])
    assert motion.speed_events(df).count() == 0
    row = status_of(df)[1]
    assert (row.status, row.velocidade_kmh, row.headway_minutos) == ("PARADO", 0.0, 9.72)


def test_fixes_within_a_second_give_no_speed(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 1, "at": 0.4, "km": 1.0}])
    assert motion.speed_events(df).count() == 0
    assert status_of(df)[1].velocidade_kmh == 0.0


def test_seconds_are_cut_not_rounded(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 1, "at": 1.9, "km": 0.01}])
    assert motion.segments(df).first().seconds == 1


def test_crawling_vehicle_gets_the_fixed_headway(reports):
    # 2.5 km/h: above the stopped limit, below the limit for a measured headway.
    df = reports([{"p": 2, "at": 0}, {"p": 1, "at": 10}, {"p": 2, "at": 20}, {"p": 1, "at": 3610, "km": 2.5}])
    row = status_of(df)[1]
    assert (row.status, row.headway_minutos) == ("NORMAL", 9.72)


def test_no_other_vehicle_gives_the_lone_headway(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 1, "at": 3600, "km": 30}])
    row = status_of(df)[1]
    assert (row.status, row.headway_minutos, row.velocidade_kmh) == ("NORMAL", 7.5, 30.0)


def test_late_status_uses_the_unrounded_headway(reports):
    # gap 5.0001 km at 30 km/h is 10.0002 minutes: shown as 10.0, but late.
    df = reports([{"p": 1, "at": 0}, {"p": 2, "at": 3590, "km": 30 - 5.0001}, {"p": 1, "at": 3600, "km": 30}])
    row = status_of(df)[1]
    assert (row.headway_minutos, row.status) == (10.0, "ATRASADO")


def test_noise_is_cut_from_speeds_but_not_from_status(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 1, "at": 3600, "km": 121}])
    assert motion.speed_by_line(df).count() == 0
    assert status_of(df)[1].velocidade_kmh == 121.0


def test_same_vehicle_twice_on_a_line_has_no_headway(reports):
    # The report before 1's second one is 1's own, and the search does not go further back.
    df = reports([{"p": 2, "at": 0}, {"p": 1, "at": 10}, {"p": 1, "at": 3610, "km": 30}])
    assert headway.headway_events(df).count() == 0


def test_direction_splits_neighbours(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 2, "at": 3590, "km": 29, "sl": 2}, {"p": 1, "at": 3600, "km": 30}])
    assert headway.headway_events(df).count() == 0


def test_speed_follows_the_vehicle_across_lines(reports):
    df = reports([{"p": 1, "at": 0, "c": "A"}, {"p": 1, "at": 3600, "km": 40, "c": "B"}])
    assert [r.linha for r in motion.speed_by_line(df).collect()] == ["B"]


def test_headway_limits(reports):
    def headways(gap, speed):
        rows = [{"p": 1, "at": 0}, {"p": 2, "at": 3590, "km": speed - gap}, {"p": 1, "at": 3600, "km": speed}]
        return headway.headway_events(reports(rows)).count()

    assert headways(1, 30) == 1
    assert headways(0.04, 30) == 0
    assert headways(1, 4.9) == 0
    assert headways(11, 5.1) == 0
    assert headways(10, 5.1) == 1


def duplicated(reports):
    """Vehicle 1 reports at one time in both directions, twice in one of them, between other vehicles."""
    return reports([
        {"p": 2, "at": 0, "sl": 1}, {"p": 3, "at": 1, "sl": 2}, {"p": 1, "at": 2, "sl": 1},
        {"p": 2, "at": 3598, "sl": 1, "km": 28}, {"p": 3, "at": 3599, "sl": 2, "km": 27},
        {"p": 1, "at": 3602, "sl": 1, "km": 30}, {"p": 1, "at": 3602, "sl": 2, "km": 30},
        {"p": 1, "at": 3602, "sl": 2, "km": 31}, {"p": 1, "at": 3602, "sl": 1, "c": "OTHER", "km": 30},
    ])


def joined_headways(df):
    """Headways written as the join of the stream with itself."""
    speeds = motion.speed_events(df).drop("event_id")
    gaps = headway.line_gaps(df).drop("sl")
    pairs = speeds.join(gaps, ["linha", "p", "event_time"]).where("speed_kmh between 5 and 120 and gap_km > 0.05")
    pairs = pairs.withColumn("headway_min", F.col("gap_km") / F.col("speed_kmh") * 60).where("headway_min <= 120")
    return pairs.select("event_id", "linha", "p", "event_time", "speed_kmh", "gap_km", "headway_min")


def test_one_pass_headways_equal_the_join_when_a_vehicle_repeats(reports):
    df = duplicated(reports)
    expected = rows_of(joined_headways(df))
    assert len(expected) >= 2
    assert rows_of(headway.headway_events(df)) == expected


def test_outer_join_multiplies_reports_of_one_time(reports):
    df = duplicated(reports)
    rows = headway.motion_with_gaps(df).where("p = 1 and linha = '627J-10'").collect()
    last = [r for r in rows if r.speed_kmh is not None and r.event_time.minute == 0 and r.event_time.second == 2]
    times = {}
    for r in last:
        times.setdefault(r.event_time, []).append(r)
    newest = times[max(times)]
    gaps = {r.gap_event_id for r in newest}
    assert len(newest) == 3 * len(gaps) and None not in gaps


def test_status_keeps_a_neighbour_any_report_of_the_time_has(reports):
    row = status_of(duplicated(reports))[1]
    assert row.ultima_atualizacao.second == 2 and row.prefixo == 1


def test_missing_sign_leaves_the_catalogue(reports):
    df = reports([{"p": 1, "at": 0, "lt1": None}, {"p": 1, "at": 1, "c": "B"}])
    rows = fleet.line_catalogue(df).collect()
    assert [(r.linha, r.linha_descricao) for r in rows] == [("B", "B | ORIG - TERM")]


def test_latest_position_takes_the_later_id_at_one_time(reports):
    df = reports([{"p": 1, "at": 5, "id": 7, "c": "A"}, {"p": 1, "at": 5, "id": 8, "c": "B"}, {"p": 1, "at": 1, "id": 9}])
    assert [r.linha for r in fleet.latest_position(df).collect()] == ["B"]


def test_active_vehicles_counts_each_once(reports):
    df = reports([{"p": 1, "at": 0}, {"p": 1, "at": 9}, {"p": 2, "at": 3}, {"p": 2, "at": 4, "c": "B"}])
    assert {r.linha: r.total_onibus_ativos for r in fleet.active_vehicles(df).collect()} == {"627J-10": 2, "B": 1}


def test_input_order_does_not_matter(reports):
    rows = [{"p": i % 3, "at": 17 * i, "km": i * 0.2 % 5, "id": i} for i in range(60)]
    straight, turned = reports(rows), reports(rows[::-1])
    for plan in (motion.speed_by_line, headway.headway_by_line, fleet.vehicle_status, fleet.latest_position):
        assert rows_of(plan(straight)) == rows_of(plan(turned))


@pytest.mark.parametrize("a,b", [((-23.5, -46.6), (-23.6, -46.7)), ((0, 0), (0, 180)), ((90, 0), (-90, 0)), ((10, 20), (10, 20))])
def test_haversine(spark, a, b):
    there, back = spark.range(1).select(
        haversine_km(*[F.lit(float(v)) for v in (*a, *b)]), haversine_km(*[F.lit(float(v)) for v in (*b, *a)])
    ).first()
    (la, lo), (lb, lp) = [tuple(map(math.radians, x)) for x in (a, b)]
    angle = math.acos(max(-1, min(1, math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(lp - lo))))
    assert there == pytest.approx(6371 * angle, abs=1e-3)
    assert there == pytest.approx(back, abs=1e-9)
