"""The JVM functions of this subpackage: ``java/*.java``, compiled to ``java/llm.jar``."""

from __future__ import annotations

import glob
import os
import subprocess
import sys
import tempfile
from pathlib import Path

import pyspark
import regex
from pyspark.sql import SparkSession

HERE = Path(__file__).parent / "java"
JAR = HERE / "llm.jar"


def classes() -> str:
    """Runs of letters (1), numbers (2) and white space (3): class, first and last code point in hex.

    Taken from the installed ``regex`` library, so that the JVM cuts by its version of Unicode.
    """
    every = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)))
    runs = [(k, m[0][0], m[0][-1]) for k, kind in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1) for m in regex.finditer(kind, every)]
    return "".join(f"{k} {ord(a):x} {ord(b):x}\n" for k, a, b in runs)


def build(jar: Path = JAR) -> None:
    with tempfile.TemporaryDirectory() as out:
        classpath = ":".join(glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "*.jar")))
        subprocess.run(["javac", "--release", "17", "-nowarn", "-cp", classpath, "-d", out, *map(str, HERE.rglob("*.java"))], check=True)
        Path(out, "littoral", "classes.txt").write_text(classes())
        subprocess.run(["jar", "--create", "--date=2020-01-01T00:00:00Z", "--file", str(jar), "-C", out, "."], check=True)


def register(spark: SparkSession, name: str, cls: str, returns: str) -> str:
    """Ship the jar with the session and make ``cls`` callable as ``name``."""
    if not JAR.exists():
        build()
    spark.sql(f"ADD JAR '{JAR}'")
    spark.udf.registerJavaFunction(name, cls, returns)
    return name


if __name__ == "__main__":
    build()
