"""Report tables derived from a classified bank."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank.plans.migrate import counters


def _each(classified: DataFrame, column: str) -> DataFrame:
    """One row per finding.

    The outer form keeps the optimizer from adding a size filter below, which
    it would evaluate by running the rules twice.
    """
    return classified.select(
        "path", "filename", "question_id", F.posexplode_outer(column).alias("seq", "x"),
    ).where("x IS NOT NULL")


def errors(classified: DataFrame) -> DataFrame:
    """One row per error, with the eight report columns and the place of the finding."""
    x = F.col("x")
    return _each(classified, "errors").select(
        F.col("filename").alias("Filename"),
        F.col("question_id").alias("Question ID"),
        x["stage"].alias("Error Type"),
        x["message"].alias("Error Message"),
        x["field"].alias("Failed Field"),
        x["actual"].alias("Actual Value"),
        x["expected"].alias("Expected Format"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("Timestamp"),
        "path", "seq",
        x["rule_id"].alias("rule_id"), x["part_no"].alias("part_no"), x["elem_no"].alias("elem_no"),
    )


def warnings(classified: DataFrame) -> DataFrame:
    """One row per warning."""
    return _each(classified, "warnings").select(
        F.col("filename").alias("Filename"),
        F.col("question_id").alias("Question ID"),
        F.col("x")["message"].alias("Warning Message"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("Timestamp"),
        "path", "seq", F.col("x")["rule_id"].alias("rule_id"),
    )


def summary(classified: DataFrame) -> DataFrame:
    """Run counters in one row; the rate is NULL for an empty bank."""
    counted = classified.agg(*counters())
    total, success = F.col("total"), F.col("success")
    return counted.select(
        "total", "success", "pre_failed", "conversion_failed", "post_failed",
        (total - success).alias("failed"), "warnings",
        F.when(total > 0, F.round(100 * success / F.nullif(total, F.lit(0)), 2)).alias("success_rate"),
        (total == success).alias("all_converted"),
    )


def errors_by_type(classified: DataFrame) -> DataFrame:
    """Error rows per stage."""
    return (
        _each(classified, "errors")
        .groupBy(F.col("x")["stage"].alias("error_type")).agg(F.count(F.lit(1)).alias("n_errors"))
    )


def errors_by_rule(classified: DataFrame) -> DataFrame:
    """Error rows per stage and rule."""
    return (
        _each(classified, "errors")
        .groupBy(F.col("x")["stage"].alias("error_type"), F.col("x")["rule_id"].alias("rule_id"))
        .agg(F.count(F.lit(1)).alias("n_errors"))
    )
