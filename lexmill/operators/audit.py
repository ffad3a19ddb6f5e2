"""Detecting inconsistent states and planning their repair.

All issues of a document follow from its own row (registry, presence flags, extraction figures), so
detection, ordering and the repair fold are array expressions without any further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.rowwise import once
from lexmill.schemas import ISSUE_TYPES, SEVERITIES

# Thresholds of the quality checks.
LOW_CONFIDENCE, HIGH_UNKNOWN_RATE = 0.3, 0.5

# One step back in the life cycle.
ROLLBACK = {
    "FETCHED": "PENDING",
    "DOWNLOADED": "FETCHED",
    "EXTRACTED": "DOWNLOADED",
    "CONSOLIDATED": "EXTRACTED",
}

# Status a repair sets, by issue type.
REPAIR_STATUS = {
    "MISSING_PDF": "FETCHED",
    "CORRUPTED_PDF": "FETCHED",
    "MISSING_OCR": "DOWNLOADED",
    "MISSING_JSON": "DOWNLOADED",
    "LOW_CONFIDENCE": "DOWNLOADED",
    "SEQUENCE_ISSUES": "DOWNLOADED",
    "HIGH_UNRECOGNIZED_WORDS": "DOWNLOADED",
    "MISSING_ARTICLES": "DOWNLOADED",
}
STUCK = ["STUCK_IN_PENDING", "STUCK_IN_FETCHED", "STUCK_IN_DOWNLOADED", "STUCK_IN_EXTRACTED"]


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def _issue(condition: Column, type_: str, severity: str) -> Column:
    return F.when(
        condition,
        F.struct(
            F.lit(type_).alias("issue_type"),
            F.lit(severity).alias("severity"),
            F.lit(SEVERITIES.index(severity)).alias("ordinal"),
            F.lit(ISSUE_TYPES[type_]).alias("auto_fixable"),
        ),
    )


def status_issues(stuck: Column | None = None) -> list[Column]:
    """Needs status, is_recorded, has_pdf. `stuck` restricts to documents waiting long enough."""
    s = F.col("status")
    waiting = stuck if stuck is not None else F.lit(True)
    done = F.col("is_recorded") & F.col("has_pdf")
    return [
        _issue((s == "PENDING") & waiting, "STUCK_IN_PENDING", "MEDIUM"),
        _issue((s == "FETCHED") & done, "STATUS_INCONSISTENT", "MEDIUM"),
        _issue((s == "FETCHED") & ~done & waiting, "STUCK_IN_FETCHED", "HIGH"),
        _issue((s == "DOWNLOADED") & waiting, "STUCK_IN_DOWNLOADED", "HIGH"),
        _issue((s == "EXTRACTED") & waiting, "STUCK_IN_EXTRACTED", "MEDIUM"),
    ]


def file_issues() -> list[Column]:
    """Needs status and the presence flags."""
    extracted = F.col("status").isin("EXTRACTED", "CONSOLIDATED")
    downloaded = extracted | (F.col("status") == "DOWNLOADED")
    return [
        _issue(downloaded & ~F.col("has_pdf"), "MISSING_PDF", "CRITICAL"),
        _issue(extracted & ~F.col("has_ocr"), "MISSING_OCR", "HIGH"),
        _issue(extracted & ~F.col("has_json"), "MISSING_JSON", "CRITICAL"),
    ]


def quality_issues() -> list[Column]:
    """Needs status, has_json, confidence, sequence_issues, unknown_rate, n_articles.

    Figures that are null are taken as absent and raise no issue, except a missing article list.
    """
    checked = F.col("status").isin("EXTRACTED", "CONSOLIDATED") & F.col("has_json")
    return [
        _issue(checked & (F.col("confidence") < LOW_CONFIDENCE), "LOW_CONFIDENCE", "HIGH"),
        _issue(checked & (F.col("sequence_issues") > 0), "SEQUENCE_ISSUES", "MEDIUM"),
        _issue(checked & (F.col("unknown_rate") > HIGH_UNKNOWN_RATE), "HIGH_UNRECOGNIZED_WORDS", "MEDIUM"),
        _issue(checked & (F.coalesce(F.col("n_articles"), F.lit(0)) == 0), "MISSING_ARTICLES", "CRITICAL"),
    ]


def extra_issues() -> list[Column]:
    """Further catalogued types, from optional flags: payload_kind, json_articles, stored_articles."""
    downloaded = F.col("status").isin("DOWNLOADED", "EXTRACTED", "CONSOLIDATED")
    return [
        _issue(downloaded & F.col("has_pdf") & (F.col("payload_kind") != "pdf"), "CORRUPTED_PDF", "CRITICAL"),
        _issue(
            (F.col("status") == "CONSOLIDATED") & (F.col("json_articles") != F.col("stored_articles")),
            "INCONSISTENT_DATA",
            "HIGH",
        ),
    ]


def detect(documents: DataFrame, detectors: list[Column]) -> DataFrame:
    """Add `issues`, an array in detector order with each issue's position."""
    found = F.array_compact(F.array(*detectors))
    placed = F.transform(found, lambda i, k: i.withField("position", k))
    return once(documents.where(F.col("status") != "FAILED"), issues=placed)


def issue_rows(detected: DataFrame, id_col: str = "document_id") -> DataFrame:
    return detected.select(id_col, F.inline("issues"))


def repair_order(issues: Column, critical_first: bool = False) -> Column:
    """Least severe first (most severe with `critical_first`), detector order within a severity."""
    sign = 1 if critical_first else -1
    keyed = F.transform(issues, lambda i: F.struct((i["ordinal"] * sign).alias("k"), i["position"].alias("p"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda x: x["i"])


def step(status: Column, issue: Column, route_inconsistent: bool = False) -> Column:
    """struct(fix_status, status_after) of one repair applied in the given status."""
    t = issue["issue_type"]
    back = _lookup(ROLLBACK, status)
    target = _lookup(REPAIR_STATUS, t)
    stuck = t.isin(STUCK)
    inconsistent = (t == "STATUS_INCONSISTENT") & F.lit(route_inconsistent)
    routed = (stuck | target.isNotNull() | inconsistent) & issue["auto_fixable"]
    after = (
        F.when(~routed, status)
        .when(inconsistent, F.lit("DOWNLOADED"))
        .when(stuck, F.coalesce(back, status))
        .otherwise(target)
    )
    outcome = (
        F.when(~routed, "SKIPPED")
        .when(stuck & (status != "PENDING") & back.isNull(), "FAILED")
        .otherwise("SUCCESS")
    )
    return F.struct(outcome.alias("fix_status"), after.alias("status_after"))


def plan_repairs(detected: DataFrame, critical_first: bool = False, route_inconsistent: bool = False) -> DataFrame:
    """Add `fixes` (in application order) and `final_status`; each repair sees the one before."""
    start = F.struct(
        F.col("status").alias("status"),
        F.array()
        .cast(
            "array<struct<issue_type:string,severity:string,status_before:string,"
            "fix_status:string,status_after:string>>"
        )
        .alias("fixes"),
    )

    def apply(acc: Column, issue: Column) -> Column:
        done = step(acc["status"], issue, route_inconsistent)
        fix = F.struct(
            issue["issue_type"].alias("issue_type"),
            issue["severity"].alias("severity"),
            acc["status"].alias("status_before"),
            done["fix_status"].alias("fix_status"),
            done["status_after"].alias("status_after"),
        )
        return F.struct(
            done["status_after"].alias("status"), F.concat(acc["fixes"], F.array(fix)).alias("fixes")
        )

    folded = F.aggregate(repair_order(F.col("issues"), critical_first), start, apply)
    return (
        once(detected, __fold=folded)
        .withColumns({"fixes": F.col("__fold.fixes"), "final_status": F.col("__fold.status")})
        .drop("__fold")
    )


def fix_rows(planned: DataFrame, id_col: str = "document_id") -> DataFrame:
    return planned.select(id_col, F.posexplode("fixes").alias("position", "fix")).select(id_col, "position", "fix.*")


def fix_summary(planned: DataFrame, id_col: str = "document_id") -> DataFrame:
    """SUCCESS / FAILED / SKIPPED counts per document."""

    def n(outcome: str) -> Column:
        return F.size(F.filter("fixes", lambda f: f["fix_status"] == outcome)).cast("long")

    return planned.select(
        id_col,
        n("SUCCESS").alias("n_success"),
        n("FAILED").alias("n_failed"),
        n("SKIPPED").alias("n_skipped"),
    )


def rollback_status(status: Column) -> Column:
    """Previous status; PENDING stays, other ends have none."""
    return F.when(status == "PENDING", status).otherwise(_lookup(ROLLBACK, status))
