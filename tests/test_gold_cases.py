"""Hand-written rows for the corners of the aggregate tables."""

import datetime as dt

from conftest import rows
from lapwright.plans import dashboard, explore

DAY = dt.datetime(2024, 3, 1, 14)


def lap(n, seconds, out=False, session=1, driver=44, **more):
    return dict(session_key=session, driver_number=driver, lap_number=n, lap_duration=seconds, is_pit_out_lap=out, **more)


def session(key, kind="Race", **more):
    return dict(session_key=key, session_type=kind, meeting_key=1, session_name=f"S{key}", location="L",
                date_start=DAY, year=2024, **more)


def driver(n, name, team="T", session_key=1, meeting=1):
    return dict(session_key=session_key, driver_number=n, full_name=name, team_name=team, meeting_key=meeting)


def test_one_lap_has_no_spread(racing):
    t = racing(laps=[lap(1, 90.0)])
    got = t["gold_driver_performance"].first()
    assert (got.total_laps, got.lap_time_consistency, got.avg_lap_time) == (1, None, 90.0)


def test_unknown_pit_flag_counts_only_in_the_race_summary(racing):
    t = racing(
        sessions=[session(1)],
        laps=[lap(1, 80.0, True), lap(2, 85.0, None), lap(3, 90.0, False), lap(9, None, False)],
    )
    perf, summary = t["gold_driver_performance"].first(), t["gold_race_summary"].first()
    assert (perf.total_laps, perf.fastest_lap_time) == (1, 90.0)
    assert (summary.total_laps, summary.fastest_lap, summary.total_pit_stops) == (3, 80.0, 1)
    assert t["gold_fastest_laps"].first().lap_number == 3


def test_equal_times_rank_by_lap_then_driver(racing):
    t = racing(laps=[lap(7, 80.0), lap(3, 80.0), lap(5, 80.0, driver=16), lap(6, 99.0, driver=16)])
    assert rows(t["gold_fastest_laps"], "rank", "driver_number", "lap_number") == [(1, 16, 5), (2, 44, 3)]


def test_stint_includes_both_edges(racing):
    t = racing(
        laps=[lap(n, float(n)) for n in (3, 4, 9, 10)],
        stints=[dict(session_key=1, driver_number=44, stint_number=2, lap_start=4, lap_end=9, compound="SOFT")],
    )
    got = t["gold_tyre_strategy"].first()
    assert (got.stint_laps, got.avg_lap_time_on_compound, got.best_lap_time_on_compound) == (6, 6.5, 4.0)


def test_stints_without_laps_or_end_vanish_and_untimed_laps_stay(racing):
    stint = dict(session_key=1, driver_number=44, compound="HARD")
    t = racing(
        laps=[lap(1, None), lap(30, 90.0)],
        stints=[
            dict(stint, stint_number=1, lap_start=1, lap_end=5),
            dict(stint, stint_number=2, lap_start=10, lap_end=20),
            dict(stint, stint_number=3, lap_start=21, lap_end=None),
            dict(stint, stint_number=4, lap_start=40, lap_end=25),
        ],
    )
    assert rows(t["gold_tyre_strategy"], "stint_number", "avg_lap_time_on_compound") == [(1, None)]


def test_unlisted_driver_and_no_pit_stops(racing):
    t = racing(laps=[lap(1, 90.0), lap(1, 92.0, driver=7)], drivers=[driver(7, "Seven", "B")])
    assert rows(t["gold_driver_performance"], "driver_number", "full_name", "pit_stop_count", "avg_pit_duration") == [
        (44, None, 0, None), (7, "Seven", 0, None)]
    assert rows(t["gold_team_performance"], "team_name", "drivers_count") == [("B", 1), (None, 1)]


def test_race_without_messages_or_weather(racing):
    got = racing(sessions=[session(1), session(2, "Practice")])["gold_race_summary"].collect()
    assert len(got) == 1
    row = got[0]
    assert (row.yellow_flags, row.red_flags, row.safety_cars) == (0, 0, 0)
    assert (row.total_laps, row.total_pit_stops, row.avg_air_temp, row.rainfall_detected) == (None, None, None, None)


def test_team_means_weigh_drivers_not_laps(racing):
    t = racing(
        laps=[lap(1, 80.0), lap(2, 80.0), lap(3, 80.0), lap(1, 90.0, driver=7)],
        drivers=[driver(44, "A"), driver(7, "B")],
    )
    assert t["gold_team_performance"].first().team_avg_lap_time == 85.0


def test_overtakes_name_needs_the_same_meeting(racing):
    made = dict(session_key=1, overtaking_driver_number=44)
    t = racing(
        overtakes=[dict(made, meeting_key=1), dict(made, meeting_key=1), dict(made, meeting_key=2)],
        drivers=[driver(44, "A", meeting=2)],
    )
    assert rows(t["gold_overtakes_analysis"], "full_name", "overtakes_made") == [("A", 1), (None, 2)]


def test_points_table(racing):
    t = racing(
        sessions=[session(1)],
        drivers=[driver(n, f"D{n:02}") for n in range(1, 13)],
        position=[dict(session_key=1, driver_number=n, date=DAY, position=n) for n in range(1, 12)]
        + [dict(session_key=1, driver_number=12, date=DAY, position=None)],
    )
    got = dashboard.championship(t, as_of="2024-04-01")
    assert [r[1] for r in rows(got, "driver", "total_points")] == [25, 18, 15, 12, 10, 8, 6, 4, 2, 1, 0, 0]
    assert got.first()["wins"] == 1 and got.selectExpr("sum(podiums)").first()[0] == 3


def test_final_position_is_the_latest_and_ties_take_the_lower(racing):
    later = DAY + dt.timedelta(minutes=1)
    t = racing(
        sessions=[session(1)], drivers=[driver(44, "A")],
        position=[dict(session_key=1, driver_number=44, date=d, position=p) for d, p in ((DAY, 1), (later, 5), (later, 3))],
    )
    assert dashboard.championship(t, as_of="2024-04-01").first().total_points == 15


def test_temperature_bands(racing):
    temps = [29.9, 30.0, 40.0, 40.1, 50.0, 50.1]
    t = racing(
        sessions=[session(k) for k in range(6)],
        weather=[dict(session_key=k, date=DAY, track_temperature=c) for k, c in enumerate(temps)],
    )
    got = [tuple(r)[:2] for r in explore.weather_bands(t).collect()]
    assert got == [("Cold (<30°C)", 1), ("Moderate (30-40°C)", 2), ("Warm (40-50°C)", 2), ("Hot (>50°C)", 1)]


def test_weather_of_like_sessions_weighs_by_laps(racing):
    """Two sessions of one name, place and start merge as if weather met every lap."""
    t = racing(
        sessions=[session(1) | {"session_name": "X"}, session(2) | {"session_name": "X"}],
        weather=[
            dict(session_key=1, date=DAY, air_temperature=10.0),
            dict(session_key=2, date=DAY, air_temperature=20.0),
        ],
        laps=[lap(n, 90.0, session=1) for n in (1, 2, 3)],
    )
    # Three laps weigh the first session three times; a session without laps weighs once.
    assert dashboard.weather_impact(t, as_of="2024-04-01").first().avg_air_temp_c == 12.5


def test_recent_sessions_count_each_driver_once(racing):
    t = racing(
        meetings=[dict(meeting_key=1, meeting_name="M", year=2024)],
        sessions=[session(k) | {"session_name": name} for k, name in ((1, "X"), (2, "X"), (3, "Y"))],
        drivers=[driver(n, "D", session_key=k) for k in (1, 2) for n in (1, 2, 17, 33 + k)],
    )
    # Sessions 1 and 2 look alike and share three drivers; session 3 has none.
    assert rows(dashboard.recent_sessions(t), "session_name", "drivers_count") == [("X", 5), ("Y", 0)]
    assert rows(dashboard.recent_sessions(t, spread=1), "drivers_count") == [(0,), (5,)]


def test_empty_tables_give_empty_answers_with_all_columns(racing):
    t = racing()
    for name in ("driver_performance", "race_summary", "team_performance", "tyre_strategy", "fastest_laps",
                 "overtakes_analysis"):
        frame = t[f"gold_{name}"]
        assert frame.count() == 0 and len(frame.columns) >= 5
    assert rows(explore.lap_distribution(t)) == []
    assert [r.total_records for r in explore.data_quality(t).collect()] == [0, 0, 0]
