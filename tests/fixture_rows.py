"""A small hand-made set of appointment records, as they arrive in a request."""

from __future__ import annotations

import datetime as dt

from rollcall.config import ClinicRule, Settings
from rollcall.schema import APPOINTMENT

UTC = dt.timezone.utc


SCORING_DAY = dt.date(2025, 3, 11)


def ms(text: str | None) -> str | None:
    if text is None:
        return None
    return str(int(dt.datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp() * 1000))


# One record or more for each rule: a missed visit outside the guard of three days and an attended one inside it, a
# change of address, a phone consult, a missing place, a missing start, a cancellation that is not missed, and
# an agenda that two clinics claim.
# patient, agenda, sub-agenda, code, consult, start, status, reason, postal, place
_ROWS = [
    ("ann", "EYE", "lens", "E1", "Fysiek", "2025-03-11T08:20:00", "planned", None, 2100, "Hall 1"),
    ("ann", "EYE", "lens", "E1", "Fysiek", "2025-03-05T08:20:00", "cancelled", "N", 2100, "Hall 1"),
    ("ann", "EYE", "lens", "E3", "Fysiek", "2025-02-01T14:00:00", "finished", None, 2101, "Hall 1"),
    ("bob", "EYE", "retina", "E2", "Telefonisch", "2025-03-11T09:40:00", "planned", None, 2102, "Hall 2"),
    ("bob", "EYE", "retina", "E2", "Fysiek", "2025-03-11T11:00:00", "planned", None, 2102, None),
    ("cas", "HEART", "echo", "H7", "Fysiek", "2025-03-11T15:10:00", "planned", None, 2103, "Hall 3"),
    ("cas", "HEART", "echo", "H7", "Fysiek", "2025-03-09T15:10:00", "finished", None, 2103, "Hall 3"),
    ("cas", "HEART", "echo", "H8", "Fysiek", None, "planned", None, 2103, "Hall 3"),
    ("dee", "HEART", "holter", "H8", "Fysiek", "2024-12-30T10:00:00", "cancelled", "X", 2104, "Hall 4"),
    ("dee", "HEART", "holter", "H8", "Fysiek", "2024-11-01T10:00:00", "finished", None, 2104, "Hall 4"),
]


def records() -> list[dict]:
    out = []
    for i, (who, agenda, sub, code, kind, start, status, reason, postal, place) in enumerate(_ROWS):
        out.append(
            {
                "APP_ID": f"{i:04d}",
                "pseudo_id": who,
                "hoofdagenda": f"Agenda {agenda}",
                "hoofdagenda_id": agenda,
                "subagenda_id": sub,
                "specialty_code": "X",
                "soort_consult": kind,
                "afspraak_code": code,
                "start": ms(start),
                "end": ms(start),
                "gearriveerd": ms(start) if status == "finished" else "",
                "created": ms("2024-10-20T07:00:00"),
                "minutesDuration": 20 + 5 * (i % 3),
                "status": status,
                "status_code_original": None,
                "mutationReason_code": reason,
                "mutationReason_display": f"reason {reason}" if reason else None,
                "BIRTH_YEAR": 1987 - 27 * (i % 2),
                "address_postalCodeNumbersNL": postal,
                "name": place,
                "description": place and f"desk {place}",
                "name_text": f"Name {who}",
                "patient_id": f"h-{who}",
                "name_given1_callMe": who,
                "telecom1_value": f"06-{who}",
                "telecom2_value": None,
                "telecom3_value": None,
                "birthDate": "-315619200000" if i % 2 else 536457600000,
            }
        )
    assert set(out[0]) == {f.name for f in APPOINTMENT.fields}
    return out


SETTINGS = Settings(
    clinics=(
        ClinicRule(name="clinic eye", main_agenda_codes=("EYE",), phone_number="1", teleq_name="e"),
        ClinicRule(name="clinic heart", main_agenda_codes=("HEART",), phone_number="2", teleq_name="h"),
        ClinicRule(
            name="clinic echo", main_agenda_codes=("HEART",), subagendas=("echo",), phone_number="3", teleq_name="x"
        ),
    )
)


def postal_codes(spark):
    return spark.createDataFrame(
        [(2100 + i, 51.5 + i / 8, 4.5 + i / 8) for i in range(5)],
        "postalcode int, latitude double, longitude double",
    )
