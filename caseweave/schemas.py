"""Fixed schemas of the input and output tables."""

from pyspark.sql import types as T

_text = T.StringType()
_texts = T.ArrayType(T.StringType())

CASE_FIELDS = T.StructType(
    [
        T.StructField("error", _text),
        T.StructField("platform", _text),
        T.StructField("context", _text),
        T.StructField("tags", _texts),
        T.StructField("explanation", _text),
        T.StructField("root_cause", _text),
        T.StructField("fix_steps", _texts),
        T.StructField("common_mistakes", _texts),
        T.StructField("solution", _text),
        T.StructField("source_type", _text),
        T.StructField("source_url", _text),
    ]
)

EVALUATION_FIELDS = T.StructType(
    [
        T.StructField("id", _text),
        T.StructField("error_message", _text),
        T.StructField("environment", _text),
        T.StructField("assignment_context", _text),
        T.StructField("code_snippet", _text),
        T.StructField("expected_focus", _texts),
        T.StructField("retrieval_method", _text),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("report_id", T.LongType()),
        T.StructField("error_message", _text),
        T.StructField("environment", _text),
        T.StructField("assignment_context", _text),
        T.StructField("code_snippet", _text),
        T.StructField("retrieval_method", _text),
    ]
)

KB_SCHEMA = T.StructType([T.StructField("kb_id", T.LongType()), *CASE_FIELDS.fields])

RETRIEVED_SCHEMA = T.StructType(
    [
        T.StructField("report_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("kb_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)

CASE_LINE_SCHEMA = T.StructType([T.StructField("report_id", T.LongType()), *EVALUATION_FIELDS.fields])

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("num_cases", T.LongType()),
        *[
            T.StructField(f"average_{name}", T.DoubleType())
            for name in ("retrieval_score", "rag_score", "baseline_score", "score_delta")
        ],
        T.StructField("rag_better_cases", T.LongType()),
        T.StructField("tied_cases", T.LongType()),
        T.StructField("baseline_better_cases", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)
