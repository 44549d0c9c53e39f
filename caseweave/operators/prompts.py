"""Request tables for a chat model, and the responses that come back as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.operators.inputs import normalize_input
from caseweave.operators.shaping import NO_EVIDENCE, examples_of, metric_columns

# Labels and instructions of the request texts.
NOT_PROVIDED = "Not provided"
EVIDENCE_HEADING = "Retrieved examples from the debugging knowledge base:"
RAG_INSTRUCTION = (
    "Important: use the retrieved examples as evidence. When a recommendation is supported by "
    "a retrieved case, name the supporting example number explicitly."
)
BASELINE_INSTRUCTION = (
    "Important: answer from direct reasoning only using the user's provided inputs. "
    "Do not mention sources, retrieved examples, or any knowledge base."
)

# Used where the caller gives no template or placeholder of their own. The numbered headings are
# those that ``sections`` splits answers at.
_LAYOUT = """Write short plain markdown under numbered headings, in this order and no others:
{headings}"""


def _template(task: str, *headings: str) -> str:
    numbered = "\n".join(f"{i}. {heading}" for i, heading in enumerate(headings, 1))
    return f"{task}\n{_LAYOUT.format(headings=numbered)}"


FALLBACK_TEMPLATES = {
    "rag": _template(
        "Explain the error and how to fix it, on the grounds of the solved cases that are given. "
        "Say which of them supports a step, and say so where they don't fit.",
        "What happened",
        "Why it happened",
        "How to fix it",
        "What to check",
        "Which case is alike",
        "Where this comes from",
        "How sure this is",
    ),
    "baseline": _template(
        "Explain the error and how to fix it, from the report alone. Name what is missing instead of guessing.",
        "What happened",
        "Why it happened",
        "How to fix it",
        "What to check",
        "How sure this is",
    ),
}
NO_RESPONSE = "No response is available for this report."


def fallback_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(FALLBACK_TEMPLATES.items()), "mode string, system_prompt string"
    )


def complete_templates(templates: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """(mode, system_prompt) with the fallback text for modes that have no template."""
    if templates is None:
        return fallback
    # one row for each mode of the fallback, which bounds what is broadcast
    known = templates.join(fallback.select("mode"), "mode", "left_semi")
    given = known.groupBy("mode").agg(_only(F.col("system_prompt"), "template", F.col("mode")).alias("given"))
    return fallback.join(F.broadcast(given), "mode", "left").select(
        "mode", F.coalesce("given", "system_prompt").alias("system_prompt")
    )


def _only(value: Column, what: str, key: Column) -> Column:
    """The one value of a group; more than one end the job."""
    several = F.raise_error(F.concat(F.lit(f"more than one {what} for "), key.cast("string")))
    return F.when(F.count(F.lit(1)) > 1, several.cast("string")).otherwise(F.max(value))


def _field(label: str, name: str, separator: str = " ") -> Column:
    value = F.when(F.col(name) == "", NOT_PROVIDED).otherwise(F.col(name))
    return F.concat(F.lit(f"{label}:{separator}"), value)


def prompt_inputs(reports: DataFrame) -> DataFrame:
    """(report_id, rag_input, baseline_input): the report as the model sees it."""
    error = _field("Error message", "error_message")
    code = _field("Code snippet", "code_snippet", "\n")
    return normalize_input(reports).select(
        "report_id",
        F.concat_ws(
            "\n",
            error,
            _field("Environment", "environment"),
            _field("Assignment context", "assignment_context"),
            code,
        ).alias("rag_input"),
        F.concat_ws("\n", error, code).alias("baseline_input"),
    )


def prompt_requests(
    reports: DataFrame,
    evidence: DataFrame,
    templates: DataFrame | None = None,
    include_baseline: bool = True,
    fallback: DataFrame | None = None,
) -> DataFrame:
    """(report_id, mode, system_prompt, user_prompt): one request per report and mode."""
    fallback = fallback_templates(reports.sparkSession) if fallback is None else fallback
    modes = complete_templates(templates, fallback)
    modes = modes.filter(F.col("mode").isin("rag", "baseline") if include_baseline else "mode = 'rag'")
    rag = F.concat_ws(
        "\n\n",
        "rag_input",
        F.concat(F.lit(f"{EVIDENCE_HEADING}\n"), F.col("evidence")),
        F.lit(RAG_INSTRUCTION),
    )
    baseline = F.concat_ws("\n\n", "baseline_input", F.lit(BASELINE_INSTRUCTION))
    shown = F.coalesce("evidence", F.lit(NO_EVIDENCE)).alias("evidence")
    inputs = prompt_inputs(reports).join(evidence, "report_id", "left")
    user_prompts = inputs.select("report_id", "rag_input", "baseline_input", shown).select(
        "report_id",
        F.explode(
            F.array(
                F.struct(F.lit("rag").alias("mode"), rag.alias("user_prompt")),
                F.struct(F.lit("baseline").alias("mode"), baseline.alias("user_prompt")),
            )
        ).alias("request"),
    )
    return (
        user_prompts.select("report_id", "request.mode", "request.user_prompt")
        .join(F.broadcast(modes), "mode")  # one row per mode
        .select("report_id", "mode", "system_prompt", "user_prompt")
    )


def response_join(
    reports: DataFrame,
    responses: DataFrame,
    placeholder: str = NO_RESPONSE,
    include_baseline: bool = True,
) -> DataFrame:
    """(report_id, rag_response, baseline_response); missing texts get the placeholder."""
    modes = ["rag", "baseline"] if include_baseline else ["rag"]
    return (
        reports.select("report_id")
        .join(responses_by_mode(responses, modes), "report_id", "left")
        .select("report_id", *_shown_responses(modes, placeholder))
    )


def responses_by_mode(responses: DataFrame, modes: list[str]) -> DataFrame:
    """(report_id, a column for each mode); two responses to one request end the job."""
    one = responses.groupBy("report_id", "mode").agg(
        _only(F.col("text"), "response", F.concat_ws(" ", F.col("report_id").cast("string"), "mode")).alias("text")
    )
    return one.groupBy("report_id").agg(
        *[F.max(F.when(F.col("mode") == mode, F.col("text"))).alias(mode) for mode in modes]
    )


def _shown_responses(modes: list[str], placeholder: str) -> list[Column]:
    return [F.coalesce(mode, F.lit(placeholder)).alias(f"{mode}_response") for mode in modes]


def run_results(
    reports: DataFrame,
    retrieved: DataFrame,
    kb: DataFrame,
    responses: DataFrame | None = None,
    placeholder: str = NO_RESPONSE,
    include_baseline: bool = True,
) -> DataFrame:
    """One row per report: cleaned input, metrics, examples, evidence and responses.

    ``retrieved_examples`` is an array of structs in rank order, empty without matches.
    """
    modes = ["rag", "baseline"] if include_baseline else ["rag"]
    if responses is None:
        responses = reports.select(
            "report_id", F.lit("rag").alias("mode"), F.lit(None).cast("string").alias("text")
        )
    examples = examples_of(retrieved, kb)
    none = F.array().cast(examples.schema["retrieved_examples"].dataType)
    return (
        normalize_input(reports)
        .join(examples, "report_id", "left")
        .join(responses_by_mode(responses, modes), "report_id", "left")
        .select(
            "report_id",
            "error_message",
            "code_snippet",
            "environment",
            "assignment_context",
            "retrieval_method",
            *metric_columns(),
            F.coalesce("retrieved_examples", none).alias("retrieved_examples"),
            F.coalesce("evidence", F.lit(NO_EVIDENCE)).alias("evidence"),
            *_shown_responses(modes, placeholder),
        )
    )
