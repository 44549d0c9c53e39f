"""Documents mixed to target weights of domains that they belong to in part.

1. A labelled table (doc_id, domain) trains a naive Bayes classifier over ``BUCKETS`` hashed
   words, in one aggregation. Of a larger table the ``SAMPLE`` first by hash of doc_id are used.
2. Every document gets a posterior for each domain. The mean log-likelihood of its words counts
   as ``EVIDENCE`` words at most, so that long texts keep some doubt.
3. Rates r >= 0 of documents are fitted so that the expected words of each domain, the sum of
   r x words x posterior, match the targets. It is accelerated projected gradient descent on
   the squared relative misses, weighted by the domains' words. In the metric of the documents'
   words the step matrix has no eigenvalue over one, so steps of length one converge:
   r' = max(0, y - sum_k p_k miss_k / words_k) at y = r + momentum x (r - r before). Where no
   document may be repeated, r' is also cut to one in every step.

Posteriors have ``DIGITS`` decimals. All rates begin at one and change by the posterior alone,
so documents with the same posterior share a rate, and the rounds run over distinct posteriors
with their words added up. A round is one aggregation; only a sum for each domain reaches the
driver. The steps are then an expression that gives each document its rate, without a join.

All of it is DataFrame functions. The posteriors, a few numbers for each document, are written
once; texts are not shuffled. A document is told from others by doc_id and hash of its text.

Defined results: null and empty texts have no words and the prior as posterior; a domain of the
targets without labelled documents keeps posterior zero and its target is left out; without any
labelled document all rates are one. Labels without doc_id or domain are not used; a doc_id
with several domains counts for each. Rows that repeat a doc_id and text share a rate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import table, without_rows
from caseweave.workspace import written

BUCKETS = 1 << 15
SAMPLE = 20_000
SMOOTHING = 0.5
#: Part of a bucket's probability that all domains share, so that words which none of them has
#: speak for none.
POOLED = 0.5
EVIDENCE = 40
DIGITS = 3
ROUNDS = 40
CLOSE = 1e-4
SEPARATORS = r"[\x20\x09-\x0D]+"


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def labelled_sample(labelled: DataFrame) -> DataFrame:
    labelled = labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL").select("doc_id", "domain").distinct()
    return labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(SAMPLE)


def classifier(docs: DataFrame, labelled: DataFrame) -> tuple[DataFrame, list[str], list[float]]:
    """(bucket, w): log-likelihoods of a bucket by domain; the domains; their log priors."""
    sample = F.broadcast(labelled_sample(labelled))
    marked = docs.select("doc_id", words(F.col("text")).alias("w")).join(sample, "doc_id")
    counts = marked.select("domain", F.explode("w").alias("word"))
    counts = counts.groupBy("domain", bucket(F.col("word")).alias("bucket")).count()
    counts = written(counts, "domain_words")
    rows = marked.groupBy("domain").agg(F.count("*").alias("docs"), F.sum(F.size("w")).alias("words"))
    rows = sorted(rows.collect(), key=lambda r: r["domain"])  # a row for each domain
    names = [r["domain"] for r in rows]
    total = sum(r["docs"] for r in rows)
    priors = [math.log(r["docs"] / total) for r in rows]
    spark = docs.sparkSession
    table = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    in_all = sum(r["words"] for r in rows)
    pooled = (F.coalesce(F.sum("count"), F.lit(0)) + SMOOTHING) / F.lit(in_all + SMOOTHING * BUCKETS)

    def likelihood(domain: str, size: int) -> Column:
        own = F.coalesce(F.sum(F.when(F.col("domain") == domain, F.col("count"))), F.lit(0))
        return F.log(own / F.lit(max(size, 1.0)) * (1 - POOLED) + pooled * POOLED)

    of_domain = [likelihood(r["domain"], float(r["words"])) for r in rows]
    weights = table.join(counts, "bucket", "left").groupBy("bucket").agg(F.array(*of_domain).alias("w"))
    return weights, names, priors


def posteriors(docs: DataFrame, labelled: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, text_hash, words, p) of every row, p in the order of the domains returned."""
    weights, names, priors = classifier(docs, labelled)
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
        words(F.col("text")).alias("w"),
    )
    split = split.select("doc_id", "text_hash", "row", F.explode_outer("w").alias("word"))
    split = split.withColumn("bucket", bucket(F.coalesce("word", F.lit(""))))
    scored = split.join(F.broadcast(weights), "bucket")  # BUCKETS rows
    sums = [F.sum(F.when(F.col("word").isNotNull(), F.col("w")[k])).alias(f"s{k}") for k in range(len(names))]
    scored = scored.groupBy("row", "doc_id", "text_hash").agg(F.count("word").alias("words"), *sums)
    weight = F.least(F.col("words"), F.lit(EVIDENCE)) / F.greatest(F.col("words"), F.lit(1))
    logs = [F.coalesce(F.col(f"s{k}") * weight, F.lit(0.0)) + F.lit(prior) for k, prior in enumerate(priors)]
    best = F.greatest(*logs) if len(logs) > 1 else (logs[0] if logs else F.lit(0.0))
    scored = scored.select("doc_id", "text_hash", "words", F.array(*logs).alias("l"), best.alias("best"))
    scored = scored.withColumn("e", F.transform("l", lambda x: F.exp(x - F.col("best"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    scored = scored.withColumn("total", total)
    p = F.transform("e", lambda x: F.round(x / F.col("total"), DIGITS)).cast("array<double>")
    return scored.select("doc_id", "text_hash", "words", p.alias("p")), names


def rate_after(steps: list[list[float]], most: float | None = None) -> Column:
    """The rate of posterior ``p``; a step has its momentum, then a change for each domain."""
    if not steps:
        return F.lit(1.0)
    listed = F.array(*[F.array(*map(F.lit, step)) for step in steps])
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("before"))

    def move(state: Column, step: Column) -> Column:
        y = state["r"] + step[0] * (state["r"] - state["before"])
        for k in range(1, len(steps[0])):
            y = y - F.col("p")[k - 1] * step[k]
        y = F.greatest(F.lit(0.0), y)
        y = y if most is None else F.least(F.lit(most), y)
        return F.struct(y.alias("r"), state["r"].alias("before"))

    return F.round(F.aggregate(listed, start, move, lambda state: state["r"]), 6)


def fitted_steps(
    members: DataFrame, names: list[str], targets: dict[str, float], budget: float | None, headroom: float, most: float | None = None, whole: str | None = None
) -> list[list[float]]:
    """Steps that bring the domains' words to their targets.

    The targets are weights of ``budget`` words in all; without one, of ``headroom`` times as
    many as no domain has to be repeated for, or as domain ``whole`` has at its weight. No rate
    gets over ``most``; a target out of reach then leaves the rates that miss least.
    """
    groups = written(members.groupBy("p").agg(F.sum("words").alias("words")), "posteriors")

    def totals(steps: list[list[float]]) -> list[float]:
        rated = groups.withColumn("rate", rate_after(steps, most))
        sums = [F.sum(F.col("words") * F.col("p")[k] * F.col("rate")).alias(f"t{k}") for k in range(len(names))]
        return [float(x or 0) for x in rated.agg(*sums).first()]

    if not names:
        return []
    have = totals([])
    weights = [targets.get(name, 0.0) if t > 0 else 0.0 for name, t in zip(names, have)]
    fixed = [name in targets and t > 0 for name, t in zip(names, have)]
    if sum(weights) <= 0:
        return []
    weights = [w / sum(weights) for w in weights]
    if budget is None:
        full = {name: t / w for name, t, w in zip(names, have, weights) if w > 0}
        budget = headroom * full.get(whole, min(full.values()))
    wanted = [w * budget for w in weights]
    steps: list[list[float]] = []
    now, before, momentum = have, have, 1.0
    for _ in range(ROUNDS):
        if max(abs(t - g) / h for t, g, h, f in zip(now, wanted, have, fixed) if f) < CLOSE:
            break
        larger = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        push, momentum = (momentum - 1) / larger, larger
        ahead = [t + push * (t - b) for t, b in zip(now, before)]
        misses = [(t - g) / h if f else 0.0 for t, g, h, f in zip(ahead, wanted, have, fixed)]
        steps.append([round(push, 9), *(round(x, 9) for x in misses)])
        now, before = totals(steps), now
        if now == before:  # all rates are held by their bounds
            break
    return steps


def rates(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None, headroom: float = 1.0, most: float | None = None, whole: str | None = None
) -> tuple[DataFrame, list[str]]:
    """(doc_id, text_hash, words, p, rate) of every row, and the domains that p refers to."""
    members, names = posteriors(docs, labelled)
    members = written(members, "members")
    steps = fitted_steps(members, names, targets, budget, headroom, most, whole)
    return members.withColumn("rate", rate_after(steps, most)), names


def even(doc_id: Column, text_hash: Column) -> Column:
    """A number in [0, 1) that only depends on the document: its id or, without one, its text."""
    return F.xxhash64(F.coalesce(doc_id, text_hash), F.lit("mixing")).bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))


def copies(rate: Column, doc_id: Column, text_hash: Column) -> Column:
    """How often a document is taken: ``rate`` on average."""
    return F.floor(rate + even(doc_id, text_hash)).cast("long")


def thinned(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], headroom: float, whole: str | None = None) -> DataFrame:
    """``docs`` without those that their rate leaves out; none is repeated.

    Rates are fitted within [0, 1], so the fitted words are those of the result. With ``whole``,
    the words of that domain alone set the budget, however scarce the others are.
    """
    found, _ = rates(docs, labelled, targets, headroom=headroom, most=1.0, whole=whole)
    return without_rows(docs, found.where(even(F.col("doc_id"), F.col("text_hash")) >= F.col("rate")))


#: Weights of the registered query: languages of good documents, and all poor ones.
TARGETS = {"en": 0.60, "de": 0.12, "es": 0.10, "fr": 0.12, "poor": 0.06}


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of documents labelled good, "poor" for others."""
    known = labels.where("quality IS NOT NULL").select("doc_id", "quality").distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", "lang").join(F.broadcast(known), "doc_id")
    return rows.select("doc_id", F.when(F.col("quality") == 0, "poor").otherwise(F.col("lang")).alias("domain"))


def op4_mixing(spark, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    words_in_all = docs.agg(F.sum(F.size(words(F.col("text"))))).first()[0]
    found, names = rates(docs, labelled_languages(docs, labels), TARGETS, budget=float(words_in_all or 0))
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        *[F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(names)],
        "rate",
        copies(F.col("rate"), F.col("doc_id"), F.col("text_hash")).alias("copies"),
    )
