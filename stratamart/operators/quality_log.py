"""The append-only quality log and the gate that may stop a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart import fixed_values as V
from stratamart.functions.cleaning import literal
from stratamart.schemas import LOG_SCHEMA

PIPELINE_NAME = "stratamart"


class QualityGateError(RuntimeError):
    """A blocking check scored below the critical bound."""


def log_row(
    score: DataFrame, task: str, layer: str, *,
    pipeline: str = PIPELINE_NAME, run_timestamp: str = "current_timestamp()",
) -> DataFrame:
    """Bring a scored frame to the log schema.

    Counters the check does not measure are 0 and issue lists empty, as readers of
    the log expect; other fields that were not measured are NULL. ``run_timestamp`` is
    a SQL expression.
    """
    given = {
        "pipeline_name": literal(pipeline), "task_name": literal(task), "layer": literal(layer),
    }
    columns = []
    for field in LOG_SCHEMA.fields:
        if field.name in given:
            value = given[field.name]
        elif field.name == "run_timestamp":
            value = run_timestamp
        elif field.name in score.columns:
            value = field.name
        elif isinstance(field.dataType, T.LongType):
            value = "0"
        elif isinstance(field.dataType, T.ArrayType):
            value = "array()"
        else:
            value = "NULL"
        columns.append(f"CAST({value} AS {field.dataType.simpleString()}) AS {field.name}")
    return score.selectExpr(*columns)


def verdict_rows(
    check: DataFrame, layer: str, *, pipeline: str = PIPELINE_NAME,
    run_timestamp: str = "current_timestamp()",
) -> DataFrame:
    """Rows of any check in one form: what was checked, the verdict, and all measures as JSON."""
    columns = set(check.columns)
    named = F.col("check_name") if "check_name" in columns else F.lit(None)
    table = F.col("table_name") if "table_name" in columns else F.lit(None)
    return check.select(
        F.expr(run_timestamp).cast("timestamp").alias("run_timestamp"),
        F.lit(pipeline).alias("pipeline_name"), F.lit(layer).alias("layer"),
        named.cast("string").alias("check_name"), table.cast("string").alias("table_name"),
        F.col("status").cast("string").alias("status"),
        F.to_json(F.struct(*check.columns)).alias("measures"),
    )


def append_log(rows: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append log rows; a failure is raised, not swallowed."""
    rows.write.mode("append").format(fmt).saveAsTable(table)


def gate_verdict(log_rows: DataFrame, blocking: bool = True) -> DataFrame:
    """Whether each row would stop the run."""
    stop = F.lit(blocking) & (F.col("quality_score") < V.CRITICAL_BELOW_SCORE)
    return log_rows.select(
        "task_name", "layer", "quality_score", "status", stop.alias("blocked"),
        F.array_join("critical_issues", "; ").alias("issues"),
    )


def enforce_gate(log_rows: DataFrame, blocking: bool = True) -> None:
    """Raise if a blocking row scored critical. Reads one row per check."""
    if not blocking:
        return
    bad = gate_verdict(log_rows).where("blocked").collect()
    if bad:
        text = "; ".join(f"{r.task_name} {r.quality_score}/100: {r.issues}" for r in bad)
        raise QualityGateError(f"quality gate closed: {text}")


def quality_trend(log: DataFrame, alert_below: int = V.PASS_SCORE) -> DataFrame:
    """Per task: change against the run before, and whether the score asks for attention."""
    runs = Window.partitionBy("pipeline_name", "task_name").orderBy("run_timestamp")
    before = F.lag("quality_score").over(runs)
    return log.select(
        "task_name", "layer", "run_timestamp", "quality_score", "status",
        before.alias("previous_score"),
        (F.col("quality_score") - before).alias("score_change"),
        (F.col("quality_score") < alert_below).alias("alert"),
        F.lead("run_timestamp").over(runs).isNull().alias("is_latest"),
    )
