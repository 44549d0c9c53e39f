"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from caseweave.llm import alignment, decontaminate, divergence, language, lines, mixing, quality, simhash, substrings, token_counts, token_files, toxicity, warc


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_quality": quality.op3_quality,
        "op4_mixing": mixing.op4_mixing,
        "op5_substrings": substrings.op5_substrings,
        "op6_lines": lines.op6_lines,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_simhash": simhash.op8_simhash,
        "op9_token_files": token_files.op9_token_files,
        "op10_warc": warc.op10_warc,
        "op11_divergence": divergence.op11_divergence,
        "op12_language": language.op12_language,
        "op13_alignment": alignment.op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": decontaminate.OP1_SQL,
        "op5_substrings": substrings.OP5_SQL,
        "op6_lines": lines.OP6_SQL,
        "op10_warc": warc.OP10_SQL,
        "op11_divergence": divergence.OP11_SQL,
    }
