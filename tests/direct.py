"""Direct single-machine scoring of small fixtures, one model per report."""

import math
import re
from collections import Counter

import numpy as np

from caseweave.functions.text import english_stop_words

STOP = set(english_stop_words())


def case(kb_id, error, platform="", context="", tags=(), cause="", steps=(), **more):
    row = dict(
        kb_id=kb_id,
        error=error,
        platform=platform,
        context=context,
        tags=list(tags or []),
        explanation="",
        root_cause=cause,
        fix_steps=list(steps),
        common_mistakes=[],
        solution="",
        source_type="docs",
        source_url=f"doc://{kb_id}",
    )
    return {**row, **more}


def report(report_id, error, environment="", context="", code="", method="tfidf"):
    return dict(
        report_id=report_id,
        error_message=error,
        environment=environment,
        assignment_context=context,
        code_snippet=code,
        retrieval_method=method,
    )


def frame(spark, rows, schema, parts=3):
    names = schema.fieldNames()
    return spark.createDataFrame([[row.get(n) for n in names] for row in rows], schema).repartition(
        parts
    )


def case_text(row):
    shown = row["platform"] if row["platform"] is not None else (row["context"] or "")
    fields = [
        ("Error", row["error"]),
        ("Platform", shown),
        ("Context", row["context"]),
        ("Explanation", row["explanation"]),
        ("Root cause", row["root_cause"]),
        ("Fix steps", " ".join(row["fix_steps"] or [])),
        ("Common mistakes", " ".join(row["common_mistakes"] or [])),
        ("Tags", " ".join(row["tags"] or [])),
    ]
    return "\n".join(f"{label}: {value or ''}" for label, value in fields)


def report_text(row):
    fields = [
        ("Error message", row["error_message"]),
        ("Environment", row["environment"]),
        ("Assignment context", row["assignment_context"]),
        ("Code snippet", row["code_snippet"]),
    ]
    cleaned = [(label, (value or "").strip()) for label, value in fields]
    return "\n".join(f"{label}: {value}" for label, value in cleaned if value)


def candidates(row, kb):
    wanted = (row["environment"] or "").strip().lower()
    places = ("platform", "context")
    found = [
        c
        for c in kb
        if wanted
        and (
            any(wanted in (c[p] or "").lower() for p in places)
            or wanted in " ".join(c["tags"] or []).lower()
        )
    ]
    return found or kb


def words(text):
    return [w for w in re.findall(r"\w\w+", text.lower()) if w not in STOP]


def tfidf_scores(row, cases):
    bags = [Counter(words(case_text(c))) for c in cases] + [Counter(words(report_text(row)))]
    df = Counter(term for bag in bags for term in bag)
    idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in df.items()}
    vectors = [{t: n * idf[t] for t, n in bag.items()} for bag in bags]
    lengths = [math.sqrt(sum(w * w for w in v.values())) for v in vectors]
    asked = vectors[-1]
    return [
        sum(w * asked.get(t, 0) for t, w in v.items()) / (length * lengths[-1])
        if length and lengths[-1]
        else 0.0
        for v, length in zip(vectors[:-1], lengths[:-1])
    ]


def overlap_scores(row, cases):
    asked = set(report_text(row).lower().split())
    return [
        len(asked & set(case_text(c).lower().split())) / max(len(asked), 1) for c in cases
    ]


def vector_scores(asked, cases, vectors):
    a = np.asarray(asked, dtype=np.float32).astype(float)
    scores = []
    for c in cases:
        b = np.asarray(vectors[c["kb_id"]], dtype=np.float32).astype(float)
        norm = math.sqrt(a @ a) * math.sqrt(b @ b)
        scores.append(float(a @ b) / norm if norm else 0.0)
    return scores


def ranking(cases, scores, k):
    ordered = sorted(zip(cases, scores), key=lambda p: (-round(p[1], 9), p[0]["kb_id"]))
    return [(c["kb_id"], round(round(s, 9), 7)) for c, s in ordered[:k]]


def by_report(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r.report_id, r.rank)):
        rows = found.setdefault(row.report_id, [])
        assert row["rank"] == len(rows) + 1
        rows.append((row.kb_id, round(row.score, 7)))
    return found
