"""Appointment-attendance analytics on Spark DataFrames.

Every operator takes and returns lazy DataFrames, so a whole pipeline is one
Catalyst plan.  The sub-packages:

* ``functions``  column expressions
* ``sources``    readers and writers
* ``operators``  DataFrame -> DataFrame transformations
* ``streaming``  micro-batch versions of the scoring job
* ``plans``      the named queries and the SQL each one must agree with
"""

from rollcall.config import ClinicRule, Settings, load_settings

__all__ = ["ClinicRule", "Settings", "load_settings"]
