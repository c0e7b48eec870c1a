"""``Boosting.java``, compiled by the compiler that Spark brings along (Janino) and sent to the executors as a jar."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

BOOST = "rollcall_boost"

#: By application: the class's instance on the driver, or None where it could not be compiled.
_READY: dict[str, object] = {}


def _compiled(spark: SparkSession) -> object:
    source = Path(__file__).with_name("Boosting.java")
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(source.read_text())
    archive = Path(tempfile.mkdtemp(prefix="rollcall-")).resolve() / "rollcall-boosting.jar"
    with zipfile.ZipFile(archive, "w") as packed:
        for entry in compiler.getBytecodes().entrySet():
            packed.writestr(f"{entry.getKey().replace('.', '/')}.class", bytes(entry.getValue()))
    spark._jsc.addJar(str(archive))
    return compiler.getClassLoader().loadClass("rollcall.Boosting").newInstance()


def register(spark: SparkSession) -> bool:
    """Make ``BOOST`` known to the session; whether that worked."""
    application = spark.sparkContext.applicationId
    if application not in _READY:
        try:
            _READY[application] = _compiled(spark)
        except Py4JError:
            _READY[application] = None
    if _READY[application] is None:
        return False
    kind = spark._jvm.org.apache.spark.sql.types.DataTypes.BinaryType
    spark._jsparkSession.udf().register(BOOST, _READY[application], kind)
    return True
