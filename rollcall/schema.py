"""Declared schemas.  Readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


APPOINTMENT = _struct(
    ("APP_ID", _S, False),
    ("pseudo_id", _S, False),
    ("hoofdagenda", _S, False),
    ("hoofdagenda_id", _S, False),
    ("subagenda_id", _S, False),
    ("specialty_code", _S, True),
    ("soort_consult", _S, True),
    ("afspraak_code", _S, False),
    ("start", _TS, False),
    ("end", _TS, False),
    ("gearriveerd", _TS, True),
    ("created", _TS, False),
    ("minutesDuration", _I, False),
    ("status", _S, True),
    ("status_code_original", _S, True),
    ("mutationReason_code", _S, True),
    ("mutationReason_display", _S, True),
    ("BIRTH_YEAR", _I, False),
    ("address_postalCodeNumbersNL", _I, True),
    ("name", _S, True),
    ("description", _S, True),
    ("name_text", _S, True),
    ("patient_id", _S, True),
    ("name_given1_callMe", _S, True),
    ("telecom1_value", _S, True),
    ("telecom2_value", _S, True),
    ("telecom3_value", _S, True),
    ("birthDate", T.DateType(), True),
)

# The extract used for training carries no contact columns.
APPOINTMENT_CSV = T.StructType(APPOINTMENT.fields[:21])

# Tab-separated postal file, no header.
POSTAL_FILE = _struct(
    ("country", _S, True),
    ("postalcode", _I, True),
    ("city", _S, True),
    ("admin_name1", _S, True),
    ("admin_code1", _S, True),
    ("admin_name2", _S, True),
    ("admin_code2", _S, True),
    ("admin_name3", _S, True),
    ("admin_code3", _S, True),
    ("latitude", _D, True),
    ("longitude", _D, True),
    ("accuracy", _I, True),
)

REQUEST = _struct(
    ("id", _L, False),
    ("timestamp", _TS, False),
    ("response_code", _I, False),
    ("response_message", _S, False),
    ("endpoint", _S, False),
    ("runtime", _D, False),
    ("api_version", _S, False),
)

PATIENT = _struct(
    ("id", _S, False),
    ("call_number", _I, True),
    ("opt_out", _I, True),
    ("treatment_group", _I, True),
)

PREDICTION = _struct(
    ("id", _L, False),
    ("appointment_id", _S, False),
    ("prediction", _D, True),
    ("start_time", _TS, False),
    ("clinic_name", _S, False),
    ("clinic_reception", _S, False),
    ("clinic_phone_number", _S, False),
    ("clinic_teleq_unit", _S, True),
    ("clinic_actual_name", _S, True),
    ("request_id", _L, False),
    ("patient_id", _S, False),
    ("active", T.BooleanType(), False),
)

CONTACT = _struct(
    ("patient_id", _S, False),
    ("hospital_number", _S, True),
    ("full_name", _S, False),
    ("first_name", _S, True),
    ("birth_date", T.DateType(), True),
    ("mobile_phone", _S, True),
    ("home_phone", _S, True),
    ("other_phone", _S, True),
)

CALL = _struct(
    ("id", _L, False),
    ("timestamp", _TS, True),
    ("user", _S, True),
    ("call_status", _S, False),
    ("call_outcome", _S, False),
    ("remarks", _S, False),
    ("prediction_id", _L, False),
)

FEATURE_COLUMNS = [
    "hour",
    "weekday",
    "minutesDuration",
    "missed",
    "prev_missed",
    "prev_missed_share",
    "age",
    "dist_hospital",
    "prev_minutes_early",
    "earlier_appointments",
    "appointments_same_day",
    "appointments_last_days",
    "days_since_created",
    "days_since_last_appointment",
]

CONTACT_COLUMNS = [
    "clinic",
    "APP_ID",
    "hoofdagenda",
    "patient_id",
    "name_text",
    "name_given1_callMe",
    "telecom1_value",
    "telecom2_value",
    "telecom3_value",
    "name",
    "description",
    "birthDate",
]
