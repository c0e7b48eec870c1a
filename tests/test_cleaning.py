"""Readers, clinic rules, labels, filters and deduplication."""

import datetime as dt
import json

import pytest
from fixture_rows import SCORING_DAY, SETTINGS, postal_codes, records
from pyspark.sql import Observation

from rollcall.config import ClinicRule, load_settings
from rollcall.operators import cleaning, features
from rollcall.sources import tables
from rollcall.sources.appointments import read_appointments_json, read_postal_codes


@pytest.fixture(scope="module")
def appointments(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("requests") / "body.json"
    path.write_text(json.dumps(records()))
    return read_appointments_json(spark, str(path), order=True)


def test_request_records(appointments):
    rows = {r.APP_ID: r for r in appointments.collect()}
    assert len(rows) == 10
    assert rows["0004"].name == rows["0004"].description == "Onbekend"
    assert rows["0000"].gearriveerd is None and rows["0007"].start is None
    assert rows["0000"].start == dt.datetime(2025, 3, 11, 8, 20)
    assert rows["0000"].birthDate == dt.date(1987, 1, 1)
    assert rows["0001"].birthDate == dt.date(1960, 1, 1)
    assert [r["_seq"] for r in sorted(rows.values(), key=lambda r: r.APP_ID)] == sorted(
        r["_seq"] for r in rows.values()
    )


@pytest.mark.parametrize(
    ("agendas", "rule", "n"),
    [
        (("EYE",), {"subagendas": ("lens",)}, 3),
        (("EYE",), {"subagendas": ("lens",), "subagenda_exclude": True}, 2),
        (("EYE", "HEART"), {"appcodes": ("H7",)}, 2),
        (("EYE", "HEART"), {"appcodes": ("H7",), "appcode_exclude": True}, 8),
    ],
)
def test_clinic_rules(appointments, agendas, rule, n):
    rules = [ClinicRule(name="all", main_agenda_codes=agendas, **rule)]
    tagged = cleaning.apply_clinic_rules(appointments, rules)
    assert tagged.count() == n
    assert cleaning.union_clinics(appointments, rules).count() == n


def test_rule_lists_and_missing_values(spark):
    rows = [("H1", None, "A"), ("H1", "S1", "A"), ("H1", "S2", None)]
    df = spark.createDataFrame(rows, "hoofdagenda_id string, subagenda_id string, afspraak_code string")
    drop = [ClinicRule(name="c", main_agenda_codes=("H1",), subagenda_exclude=True, subagendas=("S1",))]
    keep = [ClinicRule(name="c", main_agenda_codes=("H1",), appcodes=("A",))]
    assert cleaning.apply_clinic_rules(df, drop).count() == 2
    assert cleaning.apply_clinic_rules(df, keep).count() == 2


def test_several_clinics_last_one_wins(spark):
    df = spark.createDataFrame(
        [(1, "p", dt.datetime(2024, 1, 1), "H1", "S", "A", None, None, "x", 1000)],
        "_seq long, pseudo_id string, start timestamp, hoofdagenda_id string, subagenda_id string,"
        " afspraak_code string, mutationReason_code string, status string, soort_consult string,"
        " address_postalCodeNumbersNL int",
    )
    rules = [ClinicRule(name=n, main_agenda_codes=("H1", "H1")) for n in ("z", "a")]
    assert cleaning.apply_clinic_rules(df, rules).count() == 2
    assert [r.clinic for r in cleaning.clean_appointments(df, rules, "_seq").collect()] == ["a"]


def test_missing_status_and_consult_are_kept_and_counted(spark):
    rows = [
        ("missed", "finished"),
        ("missed", None),
        ("attended", None),
        ("attended", "cancelled"),
        ("missed", "cancelled"),
    ]
    df = spark.createDataFrame(rows, "missed string, status string")
    seen = Observation("dropped")
    kept = cleaning.drop_moved_and_cancelled(df, seen)
    assert kept.count() == 3
    assert seen.get == {"moved": 1, "cancelled": 1}


def test_deduplication_follows_the_given_order(spark):
    rows = [(3, "a", None, 10), (1, "a", None, 30), (2, "a", "x", 20), (4, "a", None, None)]
    df = spark.createDataFrame(rows, "_seq long, k string, v string, postal int")
    first = cleaning.dedup_ignoring(df, ["postal"], "_seq")
    assert sorted(map(tuple, first.collect()), key=str) == [(1, "a", None, 30), (2, "a", "x", 20)]
    last = cleaning.dedup_keep_last(df, ["k"], ["_seq"]).collect()
    assert [tuple(r) for r in last] == [(4, "a", None, None)]


def test_first_row_with_missing_postal_code_stays_missing(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5)], "_seq long, k string, postal int")
    assert cleaning.dedup_ignoring(df, ["postal"], "_seq").first().postal is None


def test_pipeline_row_counts(spark, appointments):
    cleaned = cleaning.clean_appointments(appointments, SETTINGS.clinics, "_seq")
    table = features.create_features(cleaned, postal_codes(spark))
    # Gone: the phone consult, the one without start, the cancellation that is not missed.
    assert table.count() == 7
    planned = {r.pseudo_id: r for r in features.filter_to_score(table, SCORING_DAY).collect()}
    assert set(planned) == {"ann", "bob", "cas"}
    ann, cas = planned["ann"], planned["cas"]
    assert (ann.earlier_appointments, ann.prev_missed) == (2, 1)
    assert ann.appointments_last_days == 2
    assert ann.days_since_last_appointment == 6
    # The visit two days before is too recent to count, but is the last one.
    assert (cas.earlier_appointments, cas.days_since_last_appointment) == (0, 2)
    # Two rules claim the echo agenda; the later one stays.
    assert {r.clinic for r in cleaned.where("pseudo_id = 'cas'").collect()} == {"clinic echo"}


def test_narrow_features_equal_wide_ones(spark, appointments):
    cleaned = cleaning.clean_appointments(appointments, SETTINGS.clinics, "_seq")
    places = postal_codes(spark)
    wide = features.select_feature_columns(features.create_features(cleaned, places, stage=False))
    narrow = features.select_feature_columns(features.create_features(cleaned, places, keep=[]))
    assert sorted(wide.collect()) == sorted(narrow.collect())


def test_cohort_keeps_whole_histories(appointments):
    cleaned = cleaning.clean_appointments(
        appointments, SETTINGS.clinics, "_seq", day=dt.date(2025, 2, 1)
    )
    assert {r.pseudo_id for r in cleaned.collect()} == {"ann"}
    assert cleaned.count() == 3


def test_postal_file_first_line_counts(spark, tmp_path):
    lines = [
        "NL\t1000\tA\tx\tx\tx\tx\tx\tx\t52.5\t4.5\t6",
        "NL\t1000\tB\tx\tx\tx\tx\tx\tx\t1.0\t1.0\t6",
        "NL\t2000\tC\tx\tx\tx\tx\tx\tx\t51.0\t5.0\t6",
    ]
    (tmp_path / "codes.txt").write_text("\n".join(lines) + "\n")
    rows = read_postal_codes(spark, str(tmp_path / "codes.txt")).orderBy("postalcode").collect()
    assert [tuple(r) for r in rows] == [(1000, 52.5, 4.5), (2000, 51.0, 5.0)]


def test_settings_file(tmp_path):
    (tmp_path / "c.toml").write_text(
        """
[preprocess]
missed_codes = ["N"]
[feature_building]
appointments_last_days = 7
[dashboard]
mute_period = 2
[clinic.sport]
include_rct = false
phone_number = "1"
teleq_name = "Sport"
main_agenda_codes = ["A"]
subagenda_exclude = true
subagendas = []
appcode_exclude = false
appcodes = ["C"]
"""
    )
    settings = load_settings(tmp_path / "c.toml")
    assert settings.appointments_last_days == 7
    assert settings.minutes_early_cutoff == 60
    assert settings.rct_clinics == []
    assert settings.clinics[0].appcodes == ["C"]


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x", query="SELECT 1")
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "query": "SELECT 1"}
    split = tables.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", "0", "9", 4))
    assert split["dbtable"] == "(SELECT 1) AS source"
    assert split["numPartitions"] == "4"
    assert tables.jdbc_options("jdbc:x", table="t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")


def test_bins_files(spark, tmp_path):
    path = tmp_path / "bins.json"
    path.write_text(json.dumps({"A": {"0.0": 0.1, "1.0": 0.9, "0.5": 0.4}}))
    read = tables.read_bins_object(spark, str(path))
    assert [tuple(r) for r in read.collect()] == [("A", [0.1, 0.4, 0.9])]
    tables.write_bins(read, str(tmp_path / "out"))
    assert tables.read_bins(spark, str(tmp_path / "out")).collect() == read.collect()
