"""Which cases a report is compared with: the environment filter.

Cases are first reduced to their distinct facets (platform, context, tags); reports to
their distinct environments. The substring test between the two runs as an equality join
on character grams followed by ``contains``, so no nested-loop join is planned.

A report whose environment matches no facet, or is blank, is compared with the whole
knowledge base. That candidate group is named by the empty string; every other group is
named by its lower-cased environment or, where environments share it, by its facets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseweave.functions.text import clean, fingerprint, joined, text_or_empty

WHOLE_KB = ""
GRAM = 3


def facet_columns() -> list[Column]:
    return [
        F.lower(text_or_empty(F.col("platform"))).alias("facet_platform"),
        F.lower(text_or_empty(F.col("context"))).alias("facet_context"),
        F.lower(joined(F.col("tags"))).alias("facet_tags"),
    ]


def with_facet(kb: DataFrame) -> DataFrame:
    """Add ``facet_id``, equal for cases that no environment can tell apart."""
    return kb.withColumn("facet_id", fingerprint(*facet_columns()))


def facets(kb: DataFrame) -> DataFrame:
    """Distinct facets: facet_id and the three lower-cased texts."""
    return with_facet(kb).select("facet_id", *facet_columns()).distinct()


def _grams(text: Column, size: int) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1))


def environment_matches(reports: DataFrame, case_facets: DataFrame) -> DataFrame:
    """(environment, facet_id) for every environment contained in a facet text."""
    environments = (
        reports.select(F.lower(clean(F.col("environment"))).alias("environment"))
        .filter(F.col("environment") != "")
        .distinct()
    )
    texts = ["facet_platform", "facet_context", "facet_tags"]
    facet_grams = case_facets.withColumn(
        "gram",
        F.explode(
            F.array_distinct(
                F.concat(*[_grams(F.col(t), size) for t in texts for size in range(1, GRAM + 1)])
            )
        ),
    )
    gram_counts = facet_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("facets_with_gram"))

    # an environment is looked up by its rarest gram only
    size = F.least(F.char_length("environment"), F.lit(GRAM))
    environment_grams = environments.withColumn(
        "gram",
        F.explode(
            F.when(size == 1, _grams(F.col("environment"), 1))
            .when(size == 2, _grams(F.col("environment"), 2))
            .otherwise(_grams(F.col("environment"), GRAM))
        ),
    )
    rarest = Window.partitionBy("environment").orderBy(
        F.coalesce("facets_with_gram", F.lit(0)), "gram"
    )
    probes = (
        environment_grams.join(gram_counts, "gram", "left")
        .withColumn("_n", F.row_number().over(rarest))
        .filter("_n = 1")
        .select("environment", "gram")
    )
    inside = [F.contains(F.col(t), F.col("environment")) for t in texts]
    return (
        probes.join(facet_grams, "gram")
        .filter(inside[0] | inside[1] | inside[2])
        .select("environment", "facet_id")
    )


def shared_groups(matches: DataFrame, case_facets: DataFrame) -> DataFrame:
    """(environment, candidate_group, first): environments that match the same facets share a group.

    Sets of facets are told apart by their size and two digests that don't depend on an order,
    so they are never gathered; these name the group, whatever the batch. ``first`` marks one
    environment of each. One that matches every facet has the group of the whole knowledge base.
    """
    facet_id = F.col("facet_id")
    same = [
        F.count(F.lit(1)).alias("facets"),
        F.bit_xor(F.xxhash64(facet_id)).alias("digest_1"),
        F.bit_xor(F.xxhash64(F.lit(1), facet_id)).alias("digest_2"),
    ]
    keys = ["facets", "digest_1", "digest_2"]
    whole = case_facets.agg(*same).select(*keys, F.lit(True).alias("whole"))
    sets = matches.groupBy("environment").agg(*same)
    firsts = sets.groupBy(*keys).agg(F.min("environment").alias("first")).join(whole, keys, "left")
    name = F.when(F.col("whole"), WHOLE_KB).otherwise(F.hex(F.xxhash64(*keys)))
    return sets.join(firsts, keys).select(
        "environment", name.alias("candidate_group"), (F.col("environment") == F.col("first")).alias("first")
    )


def first_matches(matches: DataFrame, named: DataFrame) -> DataFrame:
    """(candidate_group, facet_id) of the groups but that of the whole knowledge base."""
    firsts = named.filter(F.col("first") & (F.col("candidate_group") != WHOLE_KB))
    return matches.join(firsts, "environment").select("candidate_group", "facet_id")


def assign_groups(reports: DataFrame, named: DataFrame) -> DataFrame:
    """Add ``candidate_group`` to the reports; ``named`` holds (environment, candidate_group)."""
    named = named.select(F.col("environment").alias("_known"), "candidate_group")
    return (
        reports.withColumn("_environment", F.lower(clean(F.col("environment"))))
        .join(named, F.col("_environment") == F.col("_known"), "left")
        .withColumn("candidate_group", F.coalesce("candidate_group", F.lit(WHOLE_KB)))
        .drop("_environment", "_known")
    )


def own_groups(matches: DataFrame) -> DataFrame:
    """(candidate_group, facet_id): every environment that matches has its own group."""
    return matches.select(F.col("environment").alias("candidate_group"), "facet_id")


def group_facets(matched: DataFrame, case_facets: DataFrame, groups: DataFrame) -> DataFrame:
    """(candidate_group, facet_id) for the groups that some report belongs to."""
    wanted = groups.select("candidate_group").distinct()
    # every facet, if the group of the whole knowledge base is wanted: a product with one row
    one = F.broadcast(wanted.filter(F.col("candidate_group") == WHOLE_KB))
    whole = case_facets.select("facet_id").crossJoin(one)
    return matched.join(wanted, "candidate_group", "left_semi").unionByName(whole)


def candidate_filter(reports: DataFrame, kb: DataFrame) -> DataFrame:
    """(candidate_group, kb_id): the candidates of every group that has reports."""
    case_facets = facets(kb)
    matched = own_groups(environment_matches(reports, case_facets))
    named = matched.select(F.col("candidate_group").alias("environment"), "candidate_group").distinct()
    members = group_facets(matched, case_facets, assign_groups(reports, named))
    return with_facet(kb).select("kb_id", "facet_id").join(members, "facet_id").select(
        "candidate_group", "kb_id"
    )
