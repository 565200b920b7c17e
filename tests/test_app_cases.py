"""Parameters of the season answers, on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lapwright.plans import app, checks, dashboard, explore

DAY = dt.datetime(2024, 3, 1, 14)


@pytest.fixture
def season(racing):
    def session(key, kind, year=2024, day=1):
        return dict(session_key=key, session_type=kind, session_name=f"S{key}", location=f"L{key}", meeting_key=key,
                    date_start=dt.datetime(year, 3, day, 14), year=year)

    def lap(s, d, n, t):
        return dict(session_key=s, driver_number=d, lap_number=n, lap_duration=t, is_pit_out_lap=False, st_speed=300 + d)

    people = {44: ("Ann", "Red"), 16: ("Bo", "Red"), 7: ("Cy", None)}
    return racing(
        sessions=[session(1, "Race"), session(2, "Sprint", day=2), session(3, "Practice", day=3), session(4, "Race", 2023)],
        drivers=[dict(session_key=s, driver_number=d, full_name=n, team_name=t, meeting_key=s)
                 for s in (1, 2, 3, 4) for d, (n, t) in people.items()],
        laps=[lap(s, d, n, 80.0 + s + d / 100 + n) for s in (1, 2, 3, 4) for d in (44, 16, 7, 99) for n in (1, 2)],
        pit=[dict(session_key=1, driver_number=d, date=DAY, lap_number=2, pit_duration=p) for d, p in ((44, 22.0), (7, 20.0), (16, None))],
        stints=[dict(session_key=s, driver_number=d, stint_number=1, lap_start=1, lap_end=2, compound=c)
                for s in (1, 3) for d, c in ((44, "SOFT"), (16, "HARD"), (7, "SOFT"))],
        car_data=[dict(session_key=1, driver_number=d, date=DAY + dt.timedelta(seconds=k), speed=40 * k)
                  for d in (44, 16) for k in range(3)] + [dict(session_key=2, driver_number=7, date=DAY, speed=10)],
    )


def test_choosing_a_session_replaces_the_race_condition(season):
    assert rows(app.team_stats(season, 2024), "team_name", "race_count") == [("Red", 1), (None, 1)]
    assert rows(app.team_stats(season), "team_name", "race_count") == [("Red", 2), (None, 2)]
    practice = app.team_stats(season, 2024, session_key=3)
    assert rows(practice, "team_name", "best_lap") == [("Red", 84.16), (None, 84.07)]
    assert rows(app.team_list(season, session_key=3)) == [("Red",), (None,)]
    assert app.tyres_by_team(season, session_key=2).count() == 0


def test_year_is_optional_for_the_fastest_laps(season):
    assert [r.location for r in app.fastest_laps(season, limit=2).collect()] == ["L1", "L1"]
    assert {r.location for r in app.fastest_laps(season, year=2023).collect()} == {"L4"}


def test_chosen_drivers_and_teams(season):
    listed = app.driver_list(season, 2024)
    assert rows(app.driver_numbers(listed, ["Ann", "Cy"])) == [(44,), (7,)]
    assert rows(app.driver_stats(season, 2024, drivers=[44]), "driver", "sessions_count") == [("Ann", 3)]
    assert rows(app.driver_stats(season, 2024, 1, [44, 7]), "driver", "sessions_count") == [("Ann", 1), ("Cy", 1)]
    assert app.driver_stats(season, 2024, drivers=[]).count() == 0
    assert rows(app.tyres_by_team(season, teams=["Red"]), "compound", "usage_count") == [("HARD", 1), ("SOFT", 1)]
    assert app.tyres_by_team(season, teams=[]).count() == 3


def test_teams_without_a_name_still_meet_their_pit_stops(season):
    merged = app.team_merged(season, 2024)
    assert rows(merged, "team_name", "avg_pit_duration", "total_pit_stops") == [("Red", 22.0, 2), (None, 20.0, 1)]
    leaders = app.team_leaders(merged).first()
    assert (leaders.total_teams, leaders.fastest_team, leaders.fastest_pit_team) == (2, None, None)


def test_one_race_or_all(season):
    one, every = app.race_overview(season, 1), app.race_overview(season)
    assert "session_key" not in one.columns and every.columns[0] == "session_key"
    assert tuple(one.first()) == tuple(every.where("session_key = 1").drop("session_key").first())
    assert every.count() == 4
    assert app.race_drivers(season, 1, limit=2).count() == 2
    assert rows(app.race_pit_means(season, 1)) == [("Ann", "Red", 22.0), ("Bo", "Red", None)]
    assert rows(app.race_pits(season, 1), "driver", "pit_duration") == [("Ann", 22.0), ("Bo", None), ("Cy", 20.0)]


def test_cards(season):
    card = app.race_cards(app.race_overview(season, 1)).first()
    assert (card.total_drivers, card.fastest_lap, card.top_speed, card.total_pit_stops) == ("4", "82.070s", "399 km/h", "3")
    assert app.driver_cards(app.driver_stats(season, 2024, drivers=[44])).first().avg_pit_stops == "0.3"


def test_usage_matrix_has_a_column_for_every_compound(season):
    got = app.usage_matrix(app.tyres_by_team(season))
    assert got.columns == ["team_name", "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"]
    assert rows(got) == [("Red", 1, 0, 1, 0, 0)]
    odd = app.tyres_by_team(season).withColumn("compound", F.expr("if(compound = 'HARD', 'OTHER', compound)"))
    assert rows(app.usage_matrix(odd), "SOFT", "HARD", "OTHER") == [(1, 0, 1)]
    assert app.usage_matrix(odd, ["OTHER"]).columns == ["team_name", "OTHER"]


def test_recent_races_list_teams_by_name(season):
    got = app.recent_races(season, 2024).first()
    assert (got.session_name, got.teams_count, got.teams) == ("S3", 1, "Red")


def test_telemetry_bounds_and_coverage(season):
    assert checks.telemetry(season).count() == 7
    assert checks.telemetry(season, 40, since=DAY, until=DAY + dt.timedelta(seconds=1)).count() == 2
    got = {r.session_key: tuple(r)[1:] for r in checks.telemetry_coverage(season, 50).collect()}
    assert got[1] == (3, 2, 1, 2, 0) and got[2] == (3, 1, 2, 0, 1) and got[3] == (3, 0, 3, 0, 0)
    totals = checks.telemetry_totals(checks.telemetry_coverage(season, 50, drivers_per_session=2))
    assert totals.first().summary == "1/8 fetches successful"  # drivers 7 and 16 of each session
    assert rows(checks.telemetry_sample(season, 50, 2), "driver_number", "speed") == [(16, 80)]
    assert checks.telemetry_missing(season).count() == 9


def test_recent_is_counted_from_the_given_day(season):
    assert dashboard.fastest_laps(season, as_of="2024-05-30").where("location = 'L1'").count() == 4
    assert dashboard.fastest_laps(season, as_of="2024-05-31").where("location = 'L1'").count() == 0
    assert explore.leaderboard(season, places=1).count() == 4
