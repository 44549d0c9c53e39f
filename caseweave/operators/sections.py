"""Split response texts at their numbered headings, row by row and without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import WHITESPACE, lines, strip, text_or_empty

# What counts as a heading, and the title of text before the first one.
HEADING = rf"\A{WHITESPACE}*(?:#+{WHITESPACE}*)?\p{{Nd}}+\.{WHITESPACE}+(.+?){WHITESPACE}*\z"
OPENING_TITLE = "Response"


def response_sections(responses: DataFrame) -> DataFrame:
    """(response_id, section_no, title, body) from (response_id, text).

    A heading without a line below it makes no section; one with only blank lines keeps an
    empty body. A blank response has no sections.
    """
    split = (
        responses.select("response_id", text_or_empty(F.col("text")).alias("text"))
        .filter(strip(F.col("text")) != "")
        .select("response_id", lines(F.col("text")).alias("_lines"))
        .withColumn(
            "_heads",
            F.filter(
                F.transform("_lines", lambda line, i: F.when(F.rlike(line, F.lit(HEADING)), i)),
                lambda i: i.isNotNull(),
            ),
        )
        # the text before the first heading starts at line -1
        .withColumn("_starts", F.concat(F.array(F.lit(-1)), "_heads"))
    )

    def section(start, i):
        end = F.coalesce(F.get("_starts", i + 1), F.size("_lines"))
        count = end - start - 1
        heading = F.regexp_extract(F.get("_lines", start), HEADING, 1)
        return F.struct(
            count.alias("lines"),
            F.when(start < 0, OPENING_TITLE).otherwise(strip(heading)).alias("title"),
            strip(F.array_join(F.slice("_lines", start + 2, count), "\n")).alias("body"),
        )

    kept = F.filter(
        F.transform("_starts", section),
        lambda s: (s["lines"] > 0) & ((s["title"] != "") | (s["body"] != "")),
    )
    # the outer form infers no filter, which would copy the whole expression when pushed down
    return (
        split.select("response_id", F.posexplode_outer(kept).alias("place", "section"))
        .filter(F.col("section").isNotNull())
        .select(
            "response_id",
            (F.col("place") + 1).alias("section_no"),
            F.col("section.title").alias("title"),
            F.col("section.body").alias("body"),
        )
    )
