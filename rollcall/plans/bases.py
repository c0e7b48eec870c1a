"""The test tables seen as appointments, predictions, patients and calls.

``orders`` and ``events`` play the appointments; column expressions are written
once, in SQL both engines read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.config import ClinicRule, Settings
from rollcall.operators.cleaning import clean_appointments
from rollcall.operators.features import create_features


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark_select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select by expression; all timestamps come out without a zone, as stored."""
    out = df.selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])
    zoned = [name for name, kind in out.dtypes if kind == "timestamp"]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else out


def _sql_select(columns: dict[str, str], tail: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {tail}"


_SLOT = "o_orderdate + (9 + o_orderkey % 4) * INTERVAL '1' HOUR"

APPOINTMENT_COLUMNS = {
    "APP_ID": "o_orderkey",
    "pseudo_id": "o_custkey",
    "hoofdagenda": "'Agenda ' || c_mktsegment",
    "hoofdagenda_id": "c_mktsegment",
    "subagenda_id": "n_name",
    "soort_consult": "CASE WHEN o_orderkey % 11 = 0 THEN 'Telefonisch'"
    " WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'Controle fysiek' END",
    "afspraak_code": "o_orderpriority",
    "start": f"CASE WHEN o_orderkey % 199 = 0 THEN NULL ELSE {_SLOT} END",
    "end": f"{_SLOT} + (600 + (o_orderkey % 7) * 300 + (o_orderkey % 2) * 30)"
    " * INTERVAL '1' SECOND",
    "gearriveerd": "CASE WHEN o_orderkey % 5 = 0 THEN NULL"
    f" ELSE {_SLOT} - ((o_orderkey % 161) - 80) * INTERVAL '1' MINUTE END",
    "created": f"{_SLOT} - ((o_orderkey % 90) - 2) * INTERVAL '1' DAY - INTERVAL '5' HOUR",
    "minutesDuration": "10 + (o_orderkey % 7) * 5",
    "status": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'cancelled'"
    " WHEN o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'"
    " THEN 'planned' ELSE 'finished' END",
    "status_code_original": "CASE WHEN o_orderkey % 4 = 0 THEN 'J' WHEN o_orderkey % 4 = 1"
    " THEN NULL ELSE 'A' END",
    "mutationReason_code": "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 1 THEN 'N'"
    " WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 2 THEN '0000000012'"
    " WHEN o_orderkey % 50 = 7 THEN 'N' WHEN o_orderstatus = 'F' THEN 'X' ELSE NULL END",
    "mutationReason_display": "CASE WHEN o_orderkey % 9 = 0 THEN NULL"
    " WHEN o_orderstatus = 'F' THEN 'Reason ' || o_orderpriority ELSE NULL END",
    "BIRTH_YEAR": "CAST(1930 + o_custkey % 80 AS INT)",
    "address_postalCodeNumbersNL": "CASE WHEN o_orderkey % 101 = 0 THEN NULL"
    " ELSE CAST(1000 + c_nationkey AS INT) END",
    "_seq": "o_orderkey",
}
_APPOINTMENT_TAIL = (
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
)


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as appointments over several years; some patients have two addresses,
    which repeats their rows with another postal code."""
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
    rows = _spark_select(joined, APPOINTMENT_COLUMNS)
    copies = F.when(F.col("_seq") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    unfolded = rows.withColumn("_copy", F.explode(copies))
    return unfolded.withColumn(
        "address_postalCodeNumbersNL", F.col("address_postalCodeNumbersNL") + F.col("_copy")
    ).withColumn("_seq", F.col("_seq") * 2 + F.col("_copy")).drop("_copy")


_ALL_COLUMNS = ", ".join(f'"{c}"' for c in APPOINTMENT_COLUMNS)
_FIXED_COLUMNS = ", ".join(
    f'"{c}"'
    for c in APPOINTMENT_COLUMNS
    if c not in ("address_postalCodeNumbersNL", "_seq")
)
_SEGMENTS = {
    "A": ("BUILDING", "MACHINERY"),
    "B": ("AUTOMOBILE",),
    "C": ("HOUSEHOLD", "BUILDING"),
}
RULES = (
    ClinicRule(
        name="clinic_a",
        main_agenda_codes=_SEGMENTS["A"],
        phone_number="101",
        teleq_name="Unit A",
        subagenda_exclude=True,
        subagendas=("NATION_1", "NATION_2"),
    ),
    ClinicRule(
        name="clinic_b",
        main_agenda_codes=_SEGMENTS["B"],
        phone_number="102",
        teleq_name="Unit B",
        include_rct=False,
        appcodes=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    ),
    ClinicRule(
        name="clinic_c",
        main_agenda_codes=_SEGMENTS["C"],
        phone_number="103",
        teleq_name="Unit C",
        subagendas=tuple(f"NATION_{i}" for i in range(5, 20)),
        appcode_exclude=True,
        appcodes=("5-LOW",),
    ),
)
SETTINGS = Settings(clinics=RULES)
START_DATE = dt.date(2001, 3, 1)


def _quoted(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def _rules_sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        where = [f"hoofdagenda_id IN ({_quoted(r.main_agenda_codes)})"]
        for column, items, exclude in (
            ("subagenda_id", r.subagendas, r.subagenda_exclude),
            ("afspraak_code", r.appcodes, r.appcode_exclude),
        ):
            if items and exclude:
                where.append(f"({column} NOT IN ({_quoted(items)}) OR {column} IS NULL)")
            elif items:
                where.append(f"{column} IN ({_quoted(items)})")
        parts.append(
            f"SELECT *, '{r.name}' AS clinic, CAST({i} AS INTEGER) AS clinic_ord"
            f" FROM appts WHERE {' AND '.join(where)}"
        )
    return " UNION ALL ".join(parts)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_appointments(appointments(spark, sf_dir), RULES, "_seq")


POSTAL_COLUMNS = {
    "postalcode": "CAST(1000 + n_nationkey AS INT)",
    "latitude": "CAST(50.8 + n_nationkey * 0.1 AS DOUBLE)",
    "longitude": "CAST(4.0 + n_nationkey * 0.12 AS DOUBLE)",
}


def postal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as postal areas; those of one region have no known location."""
    known = table(spark, sf_dir, "nation").where("n_regionkey <> 4")
    return _spark_select(known, POSTAL_COLUMNS)


def features(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return create_features(cleaned(spark, sf_dir), postal_codes(spark, sf_dir), keep=keep)


# --- events as appointments and predictions ---------------------------------

EVENT_COLUMNS = {
    "APP_ID": "event_id",
    "pseudo_id": "user_id",
    "start": "ts",
    "gearriveerd": "CASE WHEN event_type = 'signup' THEN NULL ELSE ts -"
    " CAST(ROUND((value - 50) * 60000) AS BIGINT) * INTERVAL '0.001' SECOND END",
    "missed": "CASE WHEN event_type = 'error' THEN 'missed' ELSE 'attended' END",
    "clinic": "'clinic_' || CAST(event_id % 4 AS VARCHAR(4))",
}
PREDICTION_COLUMNS = {
    "id": "event_id",
    "appointment_id": "CAST(event_id AS VARCHAR(20))",
    "prediction": "value / 500",
    "start_time": "ts",
    "clinic_name": "'clinic_' || CAST(event_id % 4 AS VARCHAR(4))",
    "clinic_reception": "'desk ' || event_type",
    "clinic_phone_number": "'10' || CAST(event_id % 4 AS VARCHAR(4))",
    "clinic_teleq_unit": "CASE WHEN event_id % 4 = 3 THEN NULL ELSE 'unit' END",
    "clinic_actual_name": "'clinic_' || CAST(event_id % 4 AS VARCHAR(4))",
    "request_id": "event_id % 200",
    "patient_id": "user_id",
    "active": "event_type <> 'signup'",
}
PATIENT_COLUMNS = {
    "id": "c_custkey",
    "call_number": "CAST(c_custkey % 3 AS INT)",
    "opt_out": "CASE WHEN c_acctbal < 0 THEN 1 WHEN c_nationkey % 3 = 0 THEN NULL ELSE 0 END",
    "treatment_group": "CASE c_nationkey % 5 WHEN 0 THEN 0 WHEN 2 THEN 2 WHEN 3 THEN NULL"
    " ELSE 1 END",
}
CALL_COLUMNS = {
    "id": "event_id + 1000000",
    "timestamp": "ts - INTERVAL '3' DAY",
    "user": "'u' || CAST(event_id % 10 AS VARCHAR(4))",
    "call_status": "CASE WHEN event_id % 5 = 0 THEN 'Niet gebeld' WHEN event_id % 7 = 0"
    " THEN 'Onbereikbaar' ELSE 'Gebeld' END",
    "call_outcome": "CASE event_id % 5 WHEN 0 THEN 'Geen' WHEN 1 THEN 'Herinnerd'"
    " WHEN 2 THEN 'Onbereikbaar' WHEN 3 THEN 'Verzet/Geannuleerd'"
    " ELSE 'Voicemail ingesproken' END",
    "remarks": "props",
    "prediction_id": "event_id",
}
REQUEST_COLUMNS = {
    "id": "p_partkey",
    "timestamp": "TIMESTAMP '2024-01-01 00:30:00' + p_partkey * INTERVAL '3' HOUR",
    "response_code": "CASE WHEN p_size % 10 = 0 THEN 400 ELSE 200 END",
    "response_message": "'success'",
    "endpoint": "'predict'",
    "runtime": "p_retailprice / 100",
    "api_version": "'2.' || CAST(p_partkey % 4 AS VARCHAR(4))",
}
CONTACT_COLUMNS = {
    "patient_id": "c_custkey",
    "hospital_number": "c_name",
    "full_name": "c_name",
    "first_name": "'F' || CAST(c_custkey % 100 AS VARCHAR(4))",
    "birth_date": "CAST(TIMESTAMP '1950-01-01 00:00:00' + c_custkey * INTERVAL '1' DAY AS DATE)",
    "mobile_phone": "'06' || CAST(c_custkey % 50 AS VARCHAR(8))",
    "home_phone": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '030' ||"
    " CAST(c_custkey % 70 AS VARCHAR(8)) END",
    "other_phone": "CASE WHEN c_acctbal < 0 THEN '06' || CAST(c_nationkey AS VARCHAR(8))"
    " ELSE NULL END",
}


def event_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(table(spark, sf_dir, "events"), EVENT_COLUMNS)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(table(spark, sf_dir, "events"), PREDICTION_COLUMNS)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(table(spark, sf_dir, "customer"), PATIENT_COLUMNS)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = table(spark, sf_dir, "events").where("event_type <> 'view'")
    return _spark_select(answered, CALL_COLUMNS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(table(spark, sf_dir, "part"), REQUEST_COLUMNS)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(table(spark, sf_dir, "customer"), CONTACT_COLUMNS)


# --- the same relations in SQL ----------------------------------------------

_LAG3 = (
    "(PARTITION BY pseudo_id ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING"
    " AND INTERVAL 3 DAYS PRECEDING)"
)
_LAST14 = (
    "(PARTITION BY pseudo_id ORDER BY start RANGE BETWEEN"
    " INTERVAL '13 days 23:59:59.999999' PRECEDING AND CURRENT ROW)"
)


def floor_days_sql(later: str, earlier: str) -> str:
    return (
        f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"
    )


def haversine_sql(lat: str, lon: str) -> str:
    """Distance in the form of an arc sine, not the form the operator uses."""
    return (
        "2 * 6373.0 * asin(sqrt(pow(sin(radians(52.08593762444437::DOUBLE - ({lat})) / 2), 2)"
        " + cos(radians({lat})) * cos(radians(52.08593762444437::DOUBLE))"
        " * pow(sin(radians(5.179600848939784::DOUBLE - ({lon})) / 2), 2)))"
    ).format(lat=lat, lon=lon)


MINUTES_EARLY_SQL = (
    "least(60.0, greatest(-60.0, coalesce((epoch_us(start) - epoch_us(gearriveerd))"
    " / 60000000.0, 0.0)))::DOUBLE"
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "one_address": ((), _sql_select(APPOINTMENT_COLUMNS, _APPOINTMENT_TAIL)),
    "appts": (
        ("one_address",),
        'SELECT * REPLACE ("_seq" * 2 AS "_seq") FROM one_address UNION ALL '
        'SELECT * REPLACE ("_seq" * 2 + 1 AS "_seq",'
        ' "address_postalCodeNumbersNL" + 1 AS "address_postalCodeNumbersNL")'
        ' FROM one_address WHERE "_seq" % 17 = 0',
    ),
    "ruled": (("appts",), _rules_sql()),
    "labelled": (
        ("ruled",),
        "SELECT *, CASE WHEN mutationReason_code IN ('N', '0000000012', '0000000013')"
        " THEN 'missed' ELSE 'attended' END AS missed FROM ruled",
    ),
    "kept": (
        ("labelled",),
        "SELECT * FROM labelled WHERE NOT coalesce(missed = 'missed' AND"
        " status = 'finished', false) AND NOT coalesce(missed <> 'missed' AND"
        " status = 'cancelled', false)",
    ),
    "single": (
        ("kept",),
        f"SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY {_FIXED_COLUMNS},"
        " clinic, missed ORDER BY _seq) = 1",
    ),
    "present": (
        ("single",),
        "SELECT * FROM single WHERE start IS NOT NULL AND"
        " (soort_consult <> 'Telefonisch' OR soort_consult IS NULL)",
    ),
    "cleaned": (
        ("present",),
        "SELECT * FROM present QUALIFY row_number() OVER (PARTITION BY pseudo_id, start"
        " ORDER BY clinic_ord DESC, _seq DESC) = 1",
    ),
    "postal": (
        (),
        _sql_select(POSTAL_COLUMNS, "nation WHERE n_regionkey <> 4"),
    ),
    "history": (
        ("cleaned",),
        "SELECT *, hour(start)::INTEGER AS hour, (isodow(start) - 1)::INTEGER AS weekday,"
        f" coalesce(sum((missed = 'missed')::INTEGER) OVER {_LAG3}, 0)::BIGINT AS prev_missed,"
        f" (count(missed) OVER {_LAG3})::BIGINT AS earlier_appointments,"
        f" coalesce(sum({MINUTES_EARLY_SQL}) OVER {_LAG3}, 0.0) AS early_sum,"
        f" (count(APP_ID) OVER {_LAST14})::BIGINT AS appointments_last_days,"
        " (count(APP_ID) OVER (PARTITION BY pseudo_id, start::DATE))::BIGINT"
        " AS appointments_same_day,"
        f" greatest({floor_days_sql('start', 'created')}, 0)::BIGINT AS days_since_created,"
        " coalesce("
        + floor_days_sql("start", "lag(start) OVER (PARTITION BY pseudo_id ORDER BY start)")
        + ", 0)::BIGINT AS days_since_last_appointment,"
        " (year(start) - BIRTH_YEAR)::INTEGER AS age FROM cleaned",
    ),
    "features": (
        ("history", "postal"),
        "SELECT h.*, CASE WHEN earlier_appointments = 0 THEN 0.0"
        " ELSE prev_missed / earlier_appointments END AS prev_missed_share,"
        " CASE WHEN earlier_appointments = 0 THEN 0.0"
        " ELSE early_sum / earlier_appointments END AS prev_minutes_early,"
        f" {haversine_sql('latitude', 'longitude')} AS dist_hospital"
        " FROM history h JOIN postal ON address_postalCodeNumbersNL = postalcode",
    ),
    "ev": ((), _sql_select(EVENT_COLUMNS, "events")),
    "predictions": ((), _sql_select(PREDICTION_COLUMNS, "events")),
    "patients": ((), _sql_select(PATIENT_COLUMNS, "customer")),
    "calls": ((), _sql_select(CALL_COLUMNS, "events WHERE event_type <> 'view'")),
    "requests": ((), _sql_select(REQUEST_COLUMNS, "part")),
    "contacts": ((), _sql_select(CONTACT_COLUMNS, "customer")),
}


def with_ctes(body: str, *names: str, **extra: str) -> str:
    """Prefix a query with the named relations and everything they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


FEATURE_LIST_SQL = (
    'pseudo_id, start, hour, weekday, "minutesDuration", missed, prev_missed,'
    " round(prev_missed_share, 6) AS prev_missed_share, age,"
    " round(dist_hospital, 6) AS dist_hospital,"
    " round(prev_minutes_early, 6) AS prev_minutes_early, earlier_appointments,"
    " appointments_same_day, appointments_last_days, days_since_created,"
    " days_since_last_appointment"
)


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})
