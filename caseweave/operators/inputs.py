"""Input cleaning and the texts that are scored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import clean, joined, text_or_empty

REPORT_FIELDS = ["error_message", "code_snippet", "environment", "assignment_context"]


def normalize_input(reports: DataFrame) -> DataFrame:
    """Null to empty and strip on the four text fields; other columns stay."""
    return reports.withColumns({name: clean(F.col(name)) for name in REPORT_FIELDS})


def valid_reports(reports: DataFrame) -> DataFrame:
    """Drop reports whose error message is blank."""
    return normalize_input(reports).filter(F.col("error_message") != "")


def report_text(reports: DataFrame) -> DataFrame:
    """Add ``report_text``: labelled lines, empty fields left out."""

    def line(label: str, name: str):
        return F.when(F.col(name) != "", F.concat(F.lit(f"{label}: "), F.col(name)))

    # concat_ws skips nulls, which is how the empty fields disappear
    return normalize_input(reports).withColumn(
        "report_text",
        F.concat_ws(
            "\n",
            line("Error message", "error_message"),
            line("Environment", "environment"),
            line("Assignment context", "assignment_context"),
            line("Code snippet", "code_snippet"),
        ),
    )


def shown_platform():
    """The platform of a case, or its context when it has none."""
    return F.coalesce("platform", "context", F.lit(""))


def kb_document(kb: DataFrame) -> DataFrame:
    """Add ``document``: the eight labelled lines of a case that are scored."""

    def line(label: str, value):
        return F.concat(F.lit(f"{label}: "), value)

    return kb.withColumn(
        "document",
        F.concat_ws(
            "\n",
            line("Error", text_or_empty(F.col("error"))),
            line("Platform", shown_platform()),
            line("Context", text_or_empty(F.col("context"))),
            line("Explanation", text_or_empty(F.col("explanation"))),
            line("Root cause", text_or_empty(F.col("root_cause"))),
            line("Fix steps", joined(F.col("fix_steps"))),
            line("Common mistakes", joined(F.col("common_mistakes"))),
            line("Tags", joined(F.col("tags"))),
        ),
    )
