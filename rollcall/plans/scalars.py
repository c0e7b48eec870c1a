"""Sources, sinks, filters and scalar derivations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.scalars import haversine_km, pseudonymize
from rollcall.functions.temporal import add_working_days, birth_year, minute_boundaries
from rollcall.operators import cleaning, extract, features, outreach, reports
from rollcall.plans import bases as b
from rollcall.plans.registry import query
from rollcall.schema import APPOINTMENT
from rollcall.session import scratch_path
from rollcall.sources import appointments as files
from rollcall.sources import tables

# --- sources and sinks --------------------------------------------------------


_CSV_SCHEMA = T.StructType(
    [
        T.StructField("APP_ID", T.LongType()),
        T.StructField("pseudo_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("start", T.TimestampNTZType()),
        T.StructField("score", T.DoubleType()),
    ]
)
_ORDER_SLICE_SQL = (
    "SELECT o_orderkey AS APP_ID, o_custkey AS pseudo_id, o_orderstatus AS status,"
    " o_orderdate AS start, o_totalprice AS score FROM orders"
)


def _order_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS APP_ID",
        "o_custkey AS pseudo_id",
        "o_orderstatus AS status",
        "o_orderdate AS start",
        "o_totalprice AS score",
    )


@query("scan_appointments_csv", _ORDER_SLICE_SQL)
def scan_appointments_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _order_slice(spark, sf_dir).write.csv(path, header=True)
    return files.read_appointments_csv(spark, path, _CSV_SCHEMA)


@query(
    "scan_appointments_json",
    """SELECT CAST(event_id AS VARCHAR) AS "APP_ID", CAST(user_id AS VARCHAR) AS pseudo_id,
    date_trunc('milliseconds', ts) AS start, date_trunc('second', ts) AS created,
    CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS status,
    CASE WHEN event_type = 'click' THEN 'Onbekend' ELSE event_type END AS name,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS "minutesDuration",
    CAST(make_timestamp(-86400000000 * (event_id % 9000)) AS DATE) AS "birthDate"
    FROM events""",
)
def scan_appointments_json(spark, sf_dir):
    """Events as request records: epoch milliseconds, ISO text, blanks, null names."""
    ts = F.col("ts").cast("timestamp")
    used = {
        "APP_ID": F.col("event_id").cast("string"),
        "pseudo_id": F.col("user_id").cast("string"),
        "start": F.unix_millis(ts).cast("string"),
        "created": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "status": F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")),
        "name": F.when(F.col("event_type") != "click", F.col("event_type")),
        "minutesDuration": F.get_json_object("props", "$.k"),
        "birthDate": (F.lit(-86_400_000) * (F.col("event_id") % 9000)).cast("string"),
    }
    records = b.table(spark, sf_dir, "events").select(
        *[
            used.get(f.name, F.lit(None).cast("string")).alias(f.name)
            for f in APPOINTMENT.fields
        ]
    )
    path = scratch_path(spark, "json")
    records.write.json(path)
    read = files.read_appointments_json(spark, path, multi_line=False)
    return read.select(
        "APP_ID",
        "pseudo_id",
        F.col("start").cast("timestamp_ntz").alias("start"),
        F.col("created").cast("timestamp_ntz").alias("created"),
        "status",
        "name",
        "minutesDuration",
        "birthDate",
    )


@query(
    "scan_postal_codes",
    """SELECT CAST(1000 + s_nationkey AS INTEGER) AS postalcode,
    min_by(s_acctbal, s_suppkey) AS latitude,
    CAST(min(s_suppkey) AS DOUBLE) AS longitude FROM supplier GROUP BY 1""",
)
def scan_postal_codes(spark, sf_dir):
    """Suppliers as a 12-column tab-separated file with repeated codes."""
    lines = (
        b.table(spark, sf_dir, "supplier")
        .select(
            F.lit("NL").alias("country"),
            (1000 + F.col("s_nationkey")).alias("postalcode"),
            F.col("s_name").alias("city"),
            *[F.lit("x").alias(f"a{i}") for i in range(6)],
            F.col("s_acctbal").alias("latitude"),
            F.col("s_suppkey").cast("double").alias("longitude"),
            F.lit(4).alias("accuracy"),
        )
        .repartitionByRange(4, "longitude")
        .sortWithinPartitions("longitude")
    )
    path = scratch_path(spark, "postal")
    lines.write.csv(path, sep="\t")
    return files.read_postal_codes(spark, path)


@query(
    "scan_feature_parquet",
    b.with_ctes(
        "SELECT missed, count(*) AS n, sum(prev_missed)::BIGINT AS prev_missed"
        " FROM features GROUP BY missed",
        "features",
    ),
)
def scan_feature_parquet(spark, sf_dir):
    path = scratch_path(spark, "features")
    tables.write_features(features.select_feature_columns(b.features(spark, sf_dir, [])), path)
    return (
        tables.read_features(spark, path)
        .groupBy("missed")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("prev_missed").alias("prev_missed"))
    )


@query("sink_csv_export", _ORDER_SLICE_SQL)
def sink_csv_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    tables.write_csv(_order_slice(spark, sf_dir), path)
    return spark.read.schema(_CSV_SCHEMA).csv(path, header=True)


@query(
    "sink_feature_parquet",
    b.with_ctes(f"SELECT {b.FEATURE_LIST_SQL} FROM features", "features"),
)
def sink_feature_parquet(spark, sf_dir):
    path = scratch_path(spark, "features")
    tables.write_features(features.select_feature_columns(b.features(spark, sf_dir, [])), path)
    return b.rounded(
        tables.read_features(spark, path),
        "prev_missed_share",
        "dist_hospital",
        "prev_minutes_early",
    )


# --- scalar derivations -------------------------------------------------------


@query(
    "pseudonymize",
    """SELECT event_id, upper(sha256(CASE WHEN event_type = 'view' THEN ''
    ELSE CAST(user_id AS VARCHAR) END || 'pepper')) AS pseudo_id FROM events""",
)
def q_pseudonymize(spark, sf_dir):
    ident = F.when(F.col("event_type") != "view", F.col("user_id"))
    return b.table(spark, sf_dir, "events").select(
        "event_id", pseudonymize(ident, "pepper").alias("pseudo_id")
    )


@query(
    "minutes_duration",
    b.with_ctes(
        """SELECT "APP_ID", "_seq", date_diff('minute', start, "end") AS minutes FROM appts""",
        "appts",
    ),
)
def q_minutes_duration(spark, sf_dir):
    return b.appointments(spark, sf_dir).select(
        "APP_ID", "_seq", minute_boundaries("start", "end").alias("minutes")
    )


@query(
    "birth_year",
    b.with_ctes(
        "SELECT patient_id, year(birth_date)::INTEGER AS birth_year FROM contacts", "contacts"
    ),
)
def q_birth_year(spark, sf_dir):
    return b.contacts(spark, sf_dir).select(
        "patient_id", birth_year("birth_date").alias("birth_year")
    )


# --- eligibility --------------------------------------------------------------

_ENCOUNTER = {
    "APP_ID": "l_orderkey * 10 + l_linenumber",
    "line": "l_extendedprice",
    "patient_value": "l_suppkey",
    "start": "l_shipdate + (l_partkey % 24) * INTERVAL '1' HOUR",
    "end": "l_shipdate + (l_partkey % 24) * INTERVAL '1' HOUR + INTERVAL '30' MINUTE",
    "status": "CASE WHEN l_linestatus = 'O' AND l_quantity > 40 THEN 'planned'"
    " WHEN l_quantity < 3 THEN 'in-progress' WHEN l_quantity = 5 THEN NULL ELSE 'finished' END",
    "type2_code": "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'T'"
    " WHEN l_linenumber = 2 AND l_returnflag = 'N' THEN NULL ELSE l_returnflag END",
    "type1_code": "CASE WHEN l_partkey % 19 = 0 THEN 'FAMF' WHEN l_partkey % 23 = 0 THEN NULL"
    " ELSE 'C' || l_returnflag END",
    "type1_display": "CASE WHEN l_partkey % 17 = 0 THEN 'Telefonisch consult'"
    " WHEN l_partkey % 29 = 0 THEN 'TC kort' WHEN l_partkey % 31 = 0 THEN NULL"
    " ELSE 'Controle' END",
    "without_patient": "CASE WHEN l_tax = 0.08 THEN 1 WHEN l_tax = 0.07 THEN NULL ELSE 0 END",
    "deceased": "CASE WHEN l_suppkey % 10 = 3 THEN 1 ELSE 0 END",
    "address_active": "CASE WHEN l_discount = 0.1 THEN 0 WHEN l_discount = 0.09 THEN NULL"
    " ELSE 1 END",
    "hoofdagenda_id": "l_returnflag",
    "afspraak_code": "'P' || CAST(l_partkey % 12 AS VARCHAR(4))",
}
_ENC_SQL = b._sql_select(_ENCOUNTER, "lineitem")
_EXCLUSION_SQL = (
    "type2_code NOT IN ('T', 'S', 'M') AND type1_code NOT IN ('FAMF', 'FAMT', 'FAMS')"
    " AND lower(type1_display) NOT LIKE '%telefo%' AND lower(type1_display) NOT LIKE 'tc%'"
    " AND without_patient <> 1"
)
_ENC_OUT = ["APP_ID", "line", "start", "status", "type1_code"]
_ENC_OUT_SQL = '"APP_ID", line, start, status, type1_code'


def encounters(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "lineitem"), _ENCOUNTER)


@query(
    "eligibility_filter",
    b.with_ctes(
        f"""SELECT {_ENC_OUT_SQL} FROM enc WHERE start >= TIMESTAMP '1991-06-30 00:00:00'
        AND start >= TIMESTAMP '1999-06-30 00:00:00' - INTERVAL 96 MONTH
        AND "end" < TIMESTAMP '1999-06-30 12:00:00'
        AND status NOT IN ('planned', 'in-progress') AND {_EXCLUSION_SQL}
        AND deceased = 0 AND address_active = 1""",
        enc=_ENC_SQL,
    ),
)
def q_eligibility_filter(spark, sf_dir):
    asof = dt.datetime(1999, 6, 30, 12)
    return extract.filter_eligible(encounters(spark, sf_dir), asof).select(*_ENC_OUT)


@query(
    "prediction_window_filter",
    b.with_ctes(
        f"""SELECT {_ENC_OUT_SQL} FROM enc WHERE start >= TIMESTAMP '1997-02-10 00:00:00'
        AND start <= TIMESTAMP '2001-02-24 00:00:00' AND {_EXCLUSION_SQL}
        AND deceased = 0 AND address_active = 1""",
        enc=_ENC_SQL,
    ),
)
def q_prediction_window_filter(spark, sf_dir):
    rows = extract.filter_prediction_window(
        encounters(spark, sf_dir), dt.date(2001, 2, 10), days=14, years=4
    )
    return rows.select(*_ENC_OUT)


@query(
    "trial_cohort_filter",
    b.with_ctes(
        """SELECT "APP_ID", line, start, hoofdagenda_id, afspraak_code FROM enc
        WHERE (hoofdagenda_id IN ('A') OR (hoofdagenda_id IN ('N', 'R')
        AND afspraak_code IN ('P1', 'P4', 'P9'))) AND start >= TIMESTAMP '1998-06-18 00:00:00'
        AND start <= TIMESTAMP '1998-10-17 00:00:00'""",
        enc=_ENC_SQL,
    ),
)
def q_trial_cohort_filter(spark, sf_dir):
    rows = extract.filter_trial_cohort(
        encounters(spark, sf_dir),
        ["A"],
        ["N", "R"],
        ["P1", "P4", "P9"],
        dt.date(1998, 6, 18),
        dt.date(1998, 10, 17),
    )
    return rows.select("APP_ID", "line", "start", "hoofdagenda_id", "afspraak_code")


# --- cleaning -----------------------------------------------------------------

_RULED_SQL = 'SELECT "APP_ID", _seq, clinic, clinic_ord FROM ruled'


@query("clinic_rules", b.with_ctes(_RULED_SQL, "ruled"))
def q_clinic_rules(spark, sf_dir):
    tagged = cleaning.apply_clinic_rules(b.appointments(spark, sf_dir), b.RULES)
    return tagged.select("APP_ID", "_seq", "clinic", "clinic_ord")


@query("union_clinics", b.with_ctes(_RULED_SQL, "ruled"))
def q_union_clinics(spark, sf_dir):
    tagged = cleaning.union_clinics(b.appointments(spark, sf_dir), b.RULES)
    return tagged.select("APP_ID", "_seq", "clinic", "clinic_ord")


@query(
    "label_missed",
    b.with_ctes('SELECT "APP_ID", _seq, clinic, missed FROM labelled', "labelled"),
)
def q_label_missed(spark, sf_dir):
    tagged = cleaning.apply_clinic_rules(b.appointments(spark, sf_dir), b.RULES)
    return cleaning.label_missed(tagged).select("APP_ID", "_seq", "clinic", "missed")


@query(
    "drop_moved_and_cancelled",
    b.with_ctes('SELECT "APP_ID", _seq, clinic, missed, status FROM kept', "kept"),
)
def q_drop_moved_and_cancelled(spark, sf_dir):
    tagged = cleaning.apply_clinic_rules(b.appointments(spark, sf_dir), b.RULES)
    return cleaning.drop_moved_and_cancelled(cleaning.label_missed(tagged)).select(
        "APP_ID", "_seq", "clinic", "missed", "status"
    )


@query(
    "drop_null_start_and_phone",
    b.with_ctes(
        'SELECT "APP_ID", _seq, start, soort_consult FROM appts WHERE start IS NOT NULL'
        " AND (soort_consult <> 'Telefonisch' OR soort_consult IS NULL)",
        "appts",
    ),
)
def q_drop_null_start_and_phone(spark, sf_dir):
    return cleaning.drop_null_start_and_phone(b.appointments(spark, sf_dir)).select(
        "APP_ID", "_seq", "start", "soort_consult"
    )


_DEDUP_COLUMNS = ["APP_ID", "_seq", "clinic", "start", "address_postalCodeNumbersNL"]
_DEDUP_SQL = '"APP_ID", _seq, clinic, start, "address_postalCodeNumbersNL"'


@query("dedup_postal_variants", b.with_ctes(f"SELECT {_DEDUP_SQL} FROM single", "single"))
def q_dedup_postal_variants(spark, sf_dir):
    tagged = cleaning.apply_clinic_rules(b.appointments(spark, sf_dir), b.RULES)
    kept = cleaning.drop_moved_and_cancelled(cleaning.label_missed(tagged))
    return cleaning.dedup_ignoring(
        kept, ["address_postalCodeNumbersNL"], "_seq", skip=["clinic_ord"]
    ).select(*_DEDUP_COLUMNS)


@query("dedup_keep_last", b.with_ctes(f"SELECT {_DEDUP_SQL}, missed FROM cleaned", "cleaned"))
def q_dedup_keep_last(spark, sf_dir):
    return b.cleaned(spark, sf_dir).select(*_DEDUP_COLUMNS, "missed")


@query(
    "working_days",
    """WITH pairs AS (SELECT o_orderkey, o_orderdate::DATE AS d,
        ((o_orderkey % 13) - 6)::INTEGER AS n FROM orders),
    distinct_pairs AS (SELECT DISTINCT d, n FROM pairs),
    moved AS (SELECT d, n, CASE WHEN n = 0 THEN d ELSE
        list_filter([d + (sign(n) * i)::INTEGER FOR i IN range(1, 15)],
        lambda x: isodow(x) < 6)[abs(n)] END AS target FROM distinct_pairs)
    SELECT o_orderkey, n, target FROM pairs JOIN moved USING (d, n)""",
)
def q_working_days(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        ((F.col("o_orderkey") % 13) - 6).cast("int").alias("n"),
        add_working_days(F.to_date("o_orderdate"), (F.col("o_orderkey") % 13) - 6).alias("target"),
    )


@query(
    "computed_holidays",
    """WITH years AS (SELECT y::INTEGER AS y, (y % 19)::INTEGER AS a, (y // 100)::INTEGER AS c, (y % 100)::INTEGER AS r
      FROM range(1990, 2005) t(y)),
    ages AS (SELECT *, (19 * a + c - c // 4 - (8 * c + 13) // 25 + 15) % 30 AS h FROM years),
    moons AS (SELECT *, h - (a + 11 * h) // 319 AS d FROM ages),
    easters AS (
      SELECT y, make_date(y, 3, 22) + (d + (2 * (c % 4) + 2 * (r // 4) - r % 4 - d + 32) % 7)::INTEGER AS easter FROM moons),
    calendar AS (
      SELECT make_date(y, m, d) AS day, name FROM years,
        (VALUES (1, 1, 'Nieuwjaarsdag'), (12, 25, 'Eerste kerstdag'), (12, 26, 'Tweede kerstdag')) f(m, d, name)
      UNION ALL
      SELECT easter + n, name FROM easters,
        (VALUES (0, 'Eerste paasdag'), (1, 'Tweede paasdag'), (39, 'Hemelvaartsdag'), (49, 'Eerste pinksterdag'),
        (50, 'Tweede pinksterdag')) f(n, name)
      UNION ALL
      SELECT make_date(y, 4, 30) - (isodow(make_date(y, 4, 30)) = 7)::INTEGER, 'Koninginnedag' FROM years
      UNION ALL
      SELECT make_date(y, 5, 5), 'Bevrijdingsdag' FROM years WHERE y % 5 = 0),
    days AS (SELECT day, min(name) AS holiday FROM calendar GROUP BY day)
    SELECT o_orderkey, o_orderdate, holiday FROM orders LEFT JOIN days ON o_orderdate::DATE = day""",
)
def q_computed_holidays(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return outreach.flag_holiday(orders, "o_orderdate", outreach.feast_calendar(spark, 1990, 2004))


@query(
    "holiday_calendar",
    """WITH calendar AS (SELECT make_date(y::INTEGER, m, d) AS day, name FROM range(1995, 2002) r(y),
      (VALUES (1, 1, 'Nieuwjaarsdag'), (4, 27, 'Koningsdag'), (12, 25, 'Eerste kerstdag'),
      (12, 26, 'Tweede kerstdag')) h(m, d, name))
    SELECT o_orderkey, o_orderdate, name AS holiday FROM orders
    LEFT JOIN calendar ON o_orderdate::DATE = day""",
)
def q_holiday_calendar(spark, sf_dir):
    fixed = [(1, 1, "Nieuwjaarsdag"), (4, 27, "Koningsdag")] + [
        (12, 25, "Eerste kerstdag"),
        (12, 26, "Tweede kerstdag"),
    ]
    calendar = spark.createDataFrame(
        [(dt.date(y, m, d), name) for y in range(1995, 2002) for m, d, name in fixed],
        "date date, name string",
    )
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return outreach.flag_holiday(orders, "o_orderdate", calendar)


@query(
    "haversine",
    "WITH p AS (SELECT c_custkey, 50.0 + (c_custkey % 300) * 0.01::DOUBLE AS lat,"
    " 3.0 + c_nationkey * 0.15::DOUBLE AS lon FROM customer)"
    f" SELECT c_custkey, round({b.haversine_sql('lat', 'lon')}, 6) AS km FROM p",
)
def q_haversine(spark, sf_dir):
    lat = F.lit(50.0) + (F.col("c_custkey") % 300) * F.lit(0.01)
    lon = F.lit(3.0) + F.col("c_nationkey") * F.lit(0.15)
    return b.table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(haversine_km(lat, lon), 6).alias("km")
    )


# --- row features -------------------------------------------------------------


@query(
    "time_features",
    "SELECT event_id AS APP_ID, (isodow(ts) - 1)::INTEGER AS weekday,"
    " hour(ts)::INTEGER AS hour FROM events",
)
def q_time_features(spark, sf_dir):
    return features.add_time_features(b.event_appointments(spark, sf_dir)).select(
        "APP_ID", "weekday", "hour"
    )


@query(
    "days_since_created",
    b.with_ctes(
        f"""SELECT "APP_ID", _seq, CASE WHEN start IS NULL THEN NULL ELSE
        greatest({b.floor_days_sql('start', 'created')}, 0) END AS days_since_created FROM appts""",
        "appts",
    ),
)
def q_days_since_created(spark, sf_dir):
    return features.add_days_since_created(b.appointments(spark, sf_dir)).select(
        "APP_ID", "_seq", "days_since_created"
    )


@query(
    "minutes_early",
    b.with_ctes(
        f'SELECT "APP_ID", round({b.MINUTES_EARLY_SQL}, 6) AS minutes_early FROM ev', "ev"
    ),
)
def q_minutes_early(spark, sf_dir):
    out = features.add_minutes_early(b.event_appointments(spark, sf_dir))
    return b.rounded(out.select("APP_ID", "minutes_early"), "minutes_early")


@query(
    "patient_age",
    b.with_ctes(
        'SELECT "APP_ID", _seq, (year(start) - "BIRTH_YEAR")::INTEGER AS age FROM appts', "appts"
    ),
)
def q_patient_age(spark, sf_dir):
    return features.add_age(b.appointments(spark, sf_dir)).select("APP_ID", "_seq", "age")


@query(
    "select_features",
    b.with_ctes(f"SELECT {b.FEATURE_LIST_SQL} FROM features", "features"),
)
def q_select_features(spark, sf_dir):
    return b.rounded(
        features.select_feature_columns(b.features(spark, sf_dir, [])),
        "prev_missed_share",
        "dist_hospital",
        "prev_minutes_early",
    )


@query(
    "scoring_filter",
    b.with_ctes(
        """SELECT "APP_ID", start, earlier_appointments, appointments_last_days FROM features
        WHERE status = 'planned' AND start >= TIMESTAMP '2001-03-01 00:00:00'""",
        "features",
    ),
)
def q_scoring_filter(spark, sf_dir):
    return features.filter_to_score(b.features(spark, sf_dir, ["status"]), b.START_DATE).select(
        "APP_ID", "start", "earlier_appointments", "appointments_last_days"
    )


# --- row labels ---------------------------------------------------------------


@query(
    "trial_outcome",
    b.with_ctes(
        """SELECT "APP_ID", _seq, CASE WHEN status_code_original = 'J' THEN 'Attended'
        WHEN "mutationReason_code" = 'N' THEN 'Missed' END AS outcome FROM appts""",
        "appts",
    ),
)
def q_trial_outcome(spark, sf_dir):
    return reports.trial_outcome(b.appointments(spark, sf_dir)).select("APP_ID", "_seq", "outcome")


@query(
    "appointment_moved",
    """SELECT event_id, coalesce(e.ts <> o.o_orderdate + (r * INTERVAL '1' DAY), true)
       AS app_moved FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS r FROM
       (SELECT event_id, date_trunc('day', ts) - INTERVAL '9000' DAY AS ts FROM events)) e
       LEFT JOIN orders o ON o_orderkey = event_id""",
)
def q_appointment_moved(spark, sf_dir):
    predicted = b.table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) - INTERVAL '9000' DAY AS start_time"
    )
    actual = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS event_id",
        "o_orderdate + (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) * INTERVAL '1' DAY AS start",
    )
    return reports.flag_moved(predicted.join(actual, "event_id", "left")).select(
        "event_id", "app_moved"
    )


@query(
    "normalize_call_outcome",
    b.with_ctes(
        """SELECT id, outcome AS call_outcome, CASE outcome WHEN 'Niet gebeld' THEN 0
        WHEN 'Onbereikbaar' THEN 1 WHEN 'Herinnerd' THEN 2 WHEN 'Verzet/Geannuleerd' THEN 3 END
        AS color_sort FROM (SELECT p.id, CASE WHEN call_outcome IS NULL THEN 'Niet gebeld'
        WHEN call_outcome = 'Geen' THEN 'Onbereikbaar' ELSE call_outcome END AS outcome
        FROM predictions p LEFT JOIN calls c ON c.prediction_id = p.id)""",
        "predictions",
        "calls",
    ),
)
def q_normalize_call_outcome(spark, sf_dir):
    answers = b.calls(spark, sf_dir).select(F.col("prediction_id").alias("id"), "call_outcome")
    joined = b.predictions(spark, sf_dir).select("id").join(answers, "id", "left")
    return reports.normalize_call_outcome(joined)


@query(
    "period_label",
    """SELECT o_orderkey, CASE WHEN o_orderdate::DATE BETWEEN DATE '1999-10-05'
    AND DATE '1999-11-01' THEN 'pilot' ELSE 'Geen pilot' END AS pilot FROM orders""",
)
def q_period_label(spark, sf_dir):
    return reports.label_period(
        b.table(spark, sf_dir, "orders"),
        dt.date(1999, 10, 5),
        dt.date(1999, 11, 1),
        "o_orderdate",
    ).select("o_orderkey", "pilot")


@query(
    "remark_filter",
    """SELECT DISTINCT text FROM conversations WHERE text IS NOT NULL
    AND NOT contains(text, 'ing') AND NOT contains(text, 'que') AND NOT contains(text, 'los')""",
)
def q_remark_filter(spark, sf_dir):
    return reports.filter_remarks(
        b.table(spark, sf_dir, "conversations"), ["ing", "que", "los"], "text"
    )


@query(
    "call_status_icon",
    b.with_ctes(
        """SELECT p.id, CASE WHEN call_status = 'Gebeld' THEN 'called' ELSE 'open' END
        AS calling_icon FROM predictions p LEFT JOIN calls c ON c.prediction_id = p.id""",
        "predictions",
        "calls",
    ),
)
def q_call_status_icon(spark, sf_dir):
    answers = b.calls(spark, sf_dir).select(F.col("prediction_id").alias("id"), "call_status")
    joined = b.predictions(spark, sf_dir).select("id").join(answers, "id", "left")
    return outreach.call_marker(joined, "called", "open").select("id", "calling_icon")
