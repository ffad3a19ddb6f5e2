"""Small lookup files: correction rules, signatory patterns, dictionary, known words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """(pos, wrong, right): comments and blank lines skipped, split at the first comma.

    A repeated wrong form keeps its first position and its last replacement.
    """
    lines = _numbered_lines(spark, path).where(
        (F.trim("line") != "") & ~F.ltrim("line").startswith("#") & F.col("line").contains(",")
    )
    comma = F.instr("line", ",")
    pairs = lines.select(
        "pos",
        F.trim(F.substring(F.col("line"), F.lit(1), comma - 1)).alias("wrong"),
        F.trim(F.substring(F.col("line"), comma + 1, F.length("line"))).alias("right"),
    ).where("wrong <> '' AND right <> ''")
    return pairs.groupBy("wrong").agg(F.min("pos").alias("pos"), F.max_by("right", "pos").alias("right")).select(
        "pos", "wrong", "right"
    )


def correction_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The rules in order, for `operators.patterns.correct`: one hand-written line each."""
    rows = corrections(spark, path).orderBy("pos").collect()
    return [(r["wrong"], r["right"]) for r in rows]


def signatories(spark: SparkSession, path: str) -> DataFrame:
    """(pos, pattern, role, name, start_date, end_date): header skipped, at least three fields."""
    lines = _numbered_lines(spark, path).where((F.col("pos") > 0) & (F.trim("line") != ""))
    parts = F.split("line", ",", 5)
    return lines.where(F.size(parts) >= 3).select(
        "pos",
        F.trim(F.get(parts, 0)).alias("pattern"),
        F.trim(F.get(parts, 1)).alias("role"),
        F.trim(F.get(parts, 2)).alias("name"),
        F.try_to_date(F.trim(F.get(parts, 3)), "yyyy-MM-dd").alias("start_date"),
        F.try_to_date(F.trim(F.get(parts, 4)), "yyyy-MM-dd").alias("end_date"),
    )


def _compiles(spark: SparkSession, pattern: str) -> bool:
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
        return True
    except Exception:
        return False


def signatory_patterns(spark: SparkSession, path: str) -> list[dict]:
    """Patterns in file order, for `operators.patterns.with_signatories`; those that do not compile are dropped."""
    rows = signatories(spark, path).orderBy("pos").collect()
    return [
        {
            "pattern": r["pattern"],
            "role": r["role"],
            "name": r["name"],
            "start_date": r["start_date"] and r["start_date"].isoformat(),
            "end_date": r["end_date"] and r["end_date"].isoformat(),
        }
        for r in rows
        if _compiles(spark, r["pattern"])
    ]


def words(spark: SparkSession, path: str | None) -> DataFrame:
    """Distinct trimmed lower-case words; without a path the list is empty."""
    if path is None:
        return spark.createDataFrame([], "word string")
    return (
        spark.read.text(path)
        .select(F.lower(F.trim("value")).alias("word"))
        .where("word <> ''")
        .distinct()
    )
