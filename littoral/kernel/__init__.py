"""Exact polygon functions over WKB, in the JVM.

``java/`` holds the sources; they call the JTS library that comes with Spark.
``kernel.jar`` is their build, made anew where it is missing. ``register`` ships
it with the session and names the functions; expressions then call them by name.
"""

from __future__ import annotations

import glob
import os
import subprocess
import tempfile
from pathlib import Path

import pyspark
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

HERE = Path(__file__).parent
JAR = HERE / "kernel.jar"

FUNCTIONS = {
    "st_intersects": ("Intersects", "boolean"),
    "st_within": ("Within", "boolean"),
    "st_takes": ("Takes", "boolean"),
    "st_takes_each": ("TakesEach", "array<boolean>"),
    "st_area": ("Area", "double"),
    "st_bounds": ("Bounds", "array<double>"),
    "st_box": ("Box", "binary"),
    "st_is_box": ("IsBox", "boolean"),
    "st_clip": ("Clip", "array<binary>"),
    "st_intersection": ("Intersection", "array<binary>"),
    "st_union": ("Union", "array<binary>"),
    "st_difference": ("Difference", "array<binary>"),
    "st_union_all": ("UnionAll", "array<binary>"),
    "st_merge": ("Merge", "array<binary>"),
    "st_evolve": ("Evolve", "struct<taken: array<boolean>, steps: array<struct<rid: bigint, united: array<binary>, geom: binary, extras: array<binary>>>>"),
    "st_first_hosts": ("FirstHosts", "array<array<bigint>>"),
    "st_simplify": ("Simplify", "binary"),
    "st_asgeojson": ("AsGeoJson", "string"),
}


def build(jar: Path = JAR) -> None:
    with tempfile.TemporaryDirectory() as out:
        classpath = ":".join(glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "*.jar")))
        subprocess.run(["javac", "--release", "17", "-nowarn", "-cp", classpath, "-d", out, *map(str, (HERE / "java").rglob("*.java"))], check=True)
        subprocess.run(["jar", "--create", "--date=2020-01-01T00:00:00Z", "--file", str(jar), "-C", out, "."], check=True)


def register(spark: SparkSession) -> None:
    """Idempotent: a session that has the functions is left alone."""
    if spark.catalog.functionExists("st_first_hosts"):
        return
    if not JAR.exists():
        build()
    spark.sql(f"ADD JAR '{JAR}'")
    for name, (cls, returns) in FUNCTIONS.items():
        spark.udf.registerJavaFunction(name, f"littoral.geo.Geo${cls}", returns)


def st(name: str, *columns: Column | str) -> Column:
    """A call of a registered function."""
    if name not in FUNCTIONS:
        raise ValueError(f"no function {name}")
    return F.call_function(name, *(F.col(c) if isinstance(c, str) else c for c in columns))


