"""Fitted models: scores by plain loops, accuracy on held-out documents, targets met."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from caseweave.llm import mixing, quality, toxicity
from caseweave.llm.words import words_of
from tests.llm import plain

FOLDER = "/root/testdata/sf0.1"


def test_log_likelihood_ratio(spark):
    random.seed(1)
    good = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split(), "red green blue".split()]
    docs = [(i, " ".join(random.choices(good[0], k=30))) for i in range(40)]
    docs += [(i, " ".join(random.choices(good[1], k=30))) for i in range(40, 60)]
    docs += [(60, None), (61, ""), (None, "alpha beta"), (62, "red")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(50, 0), (None, 1), (51, None)], "doc_id long, quality int")
    model = quality.fit(frame, labels)

    def grams(text):
        w = plain.SPACE_WORD.findall(text or "")
        found, _ = quality.ngrams(words_of(pa.array([text or ""])))
        assert len(found) == len(w) + max(0, len(w) - 1)
        return found.tolist()

    counted = {
        r.doc_id
        for r in labels.where("quality = 1 AND doc_id IS NOT NULL")
        .where(F.shiftrightunsigned(F.xxhash64("doc_id"), 17) % 2 == 0)
        .collect()
    }
    raw = Counter(g for _, x in docs for g in grams(x))
    target = Counter(g for i, x in docs if i in counted for g in grams(x))
    n_raw, n_target = (sum(x.values()) + quality.SMOOTHING * quality.BUCKETS for x in (raw, target))

    def score(text):
        g = grams(text)
        s = sum(
            math.log((target[b] + quality.SMOOTHING) / n_target) - math.log((raw[b] + quality.SMOOTHING) / n_raw)
            for b in g
        )
        return s / max(1, len(g))

    held = [score(x) for i, x in docs if i is not None and i < 40 and i not in counted]
    assert model.threshold == pytest.approx(float(np.quantile(held, quality.QUANTILE)), abs=1e-8)
    judged = {(r.doc_id, r.n_words): r for r in quality.judge(frame, model).collect()}
    for i, x in docs:
        r = judged[i, plain.base_counts(x)[0]]
        assert r.score == pytest.approx(score(x), abs=1e-8)
        assert r.kept == (not r.base_failed and r.score >= model.threshold)
    assert all(judged[i, 30].kept for i in range(2, 40) if score(docs[i][1]) >= model.threshold)
    assert not any(judged[i, 30].kept for i in range(40, 60))


def test_quality_counts_all_trusted_documents(spark):
    frame = spark.range(50_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 12), k -> concat('w', pmod(xxhash64(id, k), 500)))) AS text"
    )
    labels = frame.selectExpr("doc_id", "1 AS quality")
    model = quality.fit(frame, labels)
    rows = frame.selectExpr("text", "shiftrightunsigned(xxhash64(doc_id), 17) % 2 = 0").collect()
    texts, counted = (list(x) for x in zip(*rows))
    raw = np.bincount(quality.ngrams(words_of(pa.array(texts)))[0], minlength=quality.BUCKETS)
    some = [t for t, c in zip(texts, counted) if c]
    target = np.bincount(quality.ngrams(words_of(pa.array(some)))[0], minlength=quality.BUCKETS)
    share = lambda x: np.log((x + quality.SMOOTHING) / (x.sum() + quality.SMOOTHING * quality.BUCKETS))
    assert np.allclose(model.weights, share(target) - share(raw))
    words = words_of(pa.array([t for t, c in zip(texts, counted) if not c]))
    assert model.threshold == pytest.approx(float(np.quantile(model.scores(words), quality.QUANTILE)), abs=1e-9)


@pytest.mark.parametrize("scores", [[0.5], [0.25, 0.25], [-3.0, 7.5, -3.0, 0.0, 1e-9, 2e-9], "many"])
def test_quantile_of_scores(spark, scores):
    if scores == "many":
        scores = np.round(np.random.default_rng(1).normal(size=3000) * 5, 9).tolist()
    frame = spark.createDataFrame([(x,) for x in scores], "score double")
    for share in (0.0, 0.005, 0.5, 1.0):
        assert quality.quantile(frame, share) == pytest.approx(float(np.quantile(scores, share)), abs=1e-12)
    assert quality.quantile(frame.limit(0), 0.5) is None


def test_quality_without_trusted_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "a")], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.doc_id: r.kept for r in quality.judge(docs, model).collect()} == {1: True, 2: False}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)))
    train, test = labels.where("part > 0"), labels.where("part = 0")
    found = toxicity.severity(docs, toxicity.fit(docs, train))
    rows = found.withColumnRenamed("toxic", "judged").join(test, "doc_id").collect()
    judged = sum(r.judged for r in rows)
    right = sum(r.judged and r.toxic for r in rows)
    assert right / judged > 0.97
    assert right / sum(r.toxic for r in rows) > 0.8
    kept = quality.judge(docs, quality.fit(docs, train)).join(test, "doc_id").where("NOT base_failed").collect()
    poor = [r.kept for r in kept if r.quality == 0]
    good = [r.kept for r in kept if r.quality == 1]
    assert sum(poor) / len(poor) < 0.1
    assert sum(good) / len(good) > 0.97


def test_ordinal_regression_shares_weights():
    """Slopes by finite differences are zero at the fitted point, and the cuts are in order."""
    random.seed(3)
    x = np.array([[random.random() < 0.5 for _ in range(3)] for _ in range(400)], float)
    noise = np.array([random.gauss(0, 1) for _ in range(400)])
    drive = x @ np.array([2.0, 1.0, 0.0]) + noise
    grade = (drive > 1.0).astype(int) + (drive > 2.5).astype(int)
    weights, cuts = toxicity.fit_ordinal(x, grade, 3)
    assert cuts[0] < cuts[1]
    assert weights[0] > weights[1] > abs(weights[2])

    def loss(weights, cuts):
        above = 1 / (1 + np.exp(cuts[None, :] - (x @ weights)[:, None]))
        share = np.column_stack([1 - above[:, 0], above[:, 0] - above[:, 1], above[:, 1]])
        return -np.log(share[np.arange(400), grade]).mean()

    for i in range(3):
        step = np.eye(3)[i] * 1e-4
        assert abs(loss(weights + step, cuts) - loss(weights - step, cuts)) / 2e-4 < 2e-2


def test_severity_is_the_sum_of_probabilities():
    model = toxicity.Model(np.sort(np.array([xxhash.xxh64_intdigest(b"vile")], np.uint64)), np.array([4.0]), np.array([3.0, 5.0]))
    share = model.at_least(pa.array(["so VILE, truly", "fine", "", "vile vile"]))
    on = lambda z: 1 / (1 + math.exp(-z))
    assert share[0].tolist() == pytest.approx([on(1), on(-1)])
    assert share[1].tolist() == share[2].tolist() == pytest.approx([on(-3), on(-5)])
    assert share[3].tolist() == share[0].tolist()


MIX = {"x": 0.5, "y": 0.3, "z": 0.2, "unknown": 0.4}


def mixed_documents():
    random.seed(5)
    words = {"x": "ax bx cx dx".split(), "y": "ay by cy dy".split(), "z": "az bz cz dz".split()}
    rows, labels = [], []
    for i in range(120):
        domain = "xxxxyyz"[i % 7]
        pool = words[domain] + random.sample(words["x"] + words["y"] + words["z"], 2)
        rows.append((i, " ".join(random.choices(pool, k=random.randint(3, 40)))))
        if i % 3 == 0:
            labels.append((i, domain))
    return [*rows, (200, None), (201, ""), (None, "ax ay az"), (5, "ax ax ay")], [*labels, (None, "x"), (7, None)]


def test_rates_meet_targets(spark):
    rows, labels = mixed_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("p", F.lit(1)).withColumn("row", F.lit(2))
    labelled = spark.createDataFrame(labels, "doc_id long, domain string")
    found, names = mixing.rates(docs, labelled, MIX, budget=2500.0)
    found = found.collect()
    assert names == ["x", "y", "z"] and len(found) == len(rows)
    p = np.array([r.p for r in found])
    words = np.array([r.words for r in found])
    rate = np.array([r.rate for r in found])
    assert sorted(words.tolist()) == sorted(len((x or "").split()) for _, x in rows)
    assert np.allclose(p.sum(axis=1), 1, atol=3e-3) and rate.min() >= 0
    assert (p * (words * rate)[:, None]).sum(axis=0) == pytest.approx([1250, 750, 500], rel=1e-3)
    # the same rounds, by plain loops
    have = (p * words[:, None]).sum(axis=0)
    goal = np.array([0.5, 0.3, 0.2]) * 2500
    r, before, momentum = np.ones(len(p)), np.ones(len(p)), 1.0
    for _ in range(mixing.ROUNDS):
        if np.max(np.abs((p * (words * r)[:, None]).sum(axis=0) - goal) / have) < mixing.CLOSE:
            break
        larger = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        y = r + (momentum - 1) / larger * (r - before)
        momentum = larger
        miss = ((p * (words * y)[:, None]).sum(axis=0) - goal) / have
        r, before = np.maximum(0, y - p @ miss), r
    assert rate == pytest.approx(r, abs=1e-5)


def test_posteriors_by_plain_loops(spark):
    rows, labels = mixed_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame(labels, "doc_id long, domain string")
    found, names = mixing.posteriors(docs, labelled)
    bucket = {
        r.word: r.b
        for r in spark.createDataFrame([(w,) for w in {w for _, x in rows for w in (x or "").split()}], "word string")
        .select("word", mixing.bucket(F.col("word")).alias("b"))
        .collect()
    }
    counts = {name: Counter() for name in names}
    prior = Counter()
    texts = [(i, (x or "").split()) for i, x in rows]
    for i, domain in labels:
        for j, w in texts:
            if i is not None and domain is not None and i == j:
                counts[domain].update(bucket[v] for v in w)
                prior[domain] += 1
    pooled = sum(counts.values(), Counter())
    in_all = sum(pooled.values()) + mixing.SMOOTHING * mixing.BUCKETS

    def likelihood(k, b):
        own = counts[k][b] / sum(counts[k].values())
        return math.log(own * (1 - mixing.POOLED) + mixing.POOLED * (pooled[b] + mixing.SMOOTHING) / in_all)

    expected = []
    for i, w in texts:
        weight = min(len(w), mixing.EVIDENCE) / max(len(w), 1)
        logs = [
            math.log(prior[k] / sum(prior.values()))
            + weight * sum(likelihood(k, bucket[v]) for v in w)
            for k in names
        ]
        e = [math.exp(x - max(logs)) for x in logs]
        expected.append((i, len(w), [x / sum(e) for x in e]))
    got = sorted(((r.doc_id, r.words, list(r.p)) for r in found.collect()), key=str)
    for a, b in zip(got, sorted(expected, key=str)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=6e-4)


def test_projection_reaches_zero(spark):
    members = spark.createDataFrame([([1.0, 0.0], 100), ([0.0, 1.0], 50)], "p array<double>, words long")
    steps = mixing.fitted_steps(members, ["x", "y"], {"x": 1.0, "y": 0.0}, 80.0, 1.0)
    rates = {tuple(r.p): r.rate for r in members.withColumn("rate", mixing.rate_after(steps)).collect()}
    assert rates[1.0, 0.0] == pytest.approx(0.8, abs=1e-3)
    assert rates[0.0, 1.0] == pytest.approx(0.0, abs=1e-3)


def test_mixing_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    nothing = spark.createDataFrame([], "doc_id long, domain string")
    found, names = mixing.rates(docs, nothing, MIX)
    assert names == [] and {(r.doc_id, r.words, r.rate) for r in found.collect()} == {(1, 2, 1.0), (2, 0, 1.0)}
    empty = docs.limit(0)
    found, names = mixing.rates(empty, nothing, MIX)
    assert found.count() == 0
    assert mixing.thinned(docs, nothing, MIX, 1.02).count() == 2


@pytest.mark.parametrize("percent", [0, 1, 3, 30])
def test_scarce_poor_text_thins_no_good_document(spark, percent):
    """300 documents of equal length, so the poor ones' share of the words is ``percent``."""
    random.seed(11)
    poor = {i for i in range(300) if i % 100 < percent}
    pool = {True: [f"bad{k}" for k in range(40)], False: [f"fine{k}" for k in range(40)]}
    rows = [(i, " ".join(random.choices(pool[i in poor], k=30))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "poor" if i in poor else "good") for i in range(300)], "doc_id long, domain string")
    targets = {"good": 0.92, "poor": 0.08}
    kept = {r.doc_id for r in mixing.thinned(docs, labelled, targets, 1.08, whole="good").collect()}
    assert kept >= set(range(300)) - poor
    if percent < 7:
        assert len(kept) == 300
        return
    # the poor words are those of their weight beside 1.08 times the good ones
    found, names = mixing.rates(docs, labelled, targets, headroom=1.08, most=1.0, whole="good")
    found = found.collect()
    assert all(0 <= r.rate <= 1 for r in found)
    words = sum(r.words * r.rate * r.p[names.index("poor")] for r in found)
    assert words == pytest.approx(1.08 * 210 * 30 * 0.08 / 0.92, rel=0.02)


def test_listed_words_of_toxicity(spark):
    """The list against its definition; a third of the documents share a passage and are no copies."""
    random.seed(29)
    plain_words = [f"word{i}" for i in range(300)]
    passage = random.choices(plain_words, k=12)
    rows, labels = [], []
    for i in range(360):
        w = random.choices(plain_words, k=30)
        if i % 3 == 0:
            w = passage + w
        if i % 4 == 0:
            w += random.choices(["vile", "Foul!", "nasty,"], k=3)
            w += ["rare"] * (i < 12)
        random.shuffle(w)
        rows.append((i, " ".join(w)))
        labels += [(i, int(i % 4 == 0)), (i, 0)]  # labelled twice: one of them counts
    rows += [(400, rows[0][1]), (401, None), (402, "")]
    labels += [(400, 1), (401, 0), (402, 1), (None, 1), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    toxic = {}
    for d, x in labels:
        if d is not None and x is not None:
            toxic[d] = max(toxic.get(d, 0), x)
    seen = [(toxic[d], {x.strip("!,").lower() for x in (t or "").split()}) for d, t in rows if d != 400]
    p = sum(y for y, _ in seen) / len(seen)
    listed = set()
    for word in set().union(*(w for _, w in seen)):
        held = [y for y, w in seen if word in w]
        z = (sum(held) - len(held) * p) / math.sqrt(len(held) * p * (1 - p))
        if z >= toxicity.LEAST_Z and len(held) >= toxicity.LEAST_DOCS:
            listed.add(xxhash.xxh64_intdigest(word.encode()))
    assert set(model.features.tolist()) == listed and len(listed) == 3
    found = {r.doc_id: r.toxic for r in toxicity.severity(docs, model).collect()}
    assert all(found[i] == (i % 4 == 0) for i in range(360))


def test_only_copies_leave_the_sample():
    random.seed(31)
    words = [f"w{i}" for i in range(3_000)]
    shared = random.choices(words, k=100)
    texts = [" ".join(shared + random.choices(words, k=300)) for _ in range(200)]
    copies = [" ".join(x.split()[:-1] + ["other"]) for x in texts[:50]]
    kept = toxicity.first_of_copies(toxicity.sketches(pa.array([*texts, *copies, texts[0]])))
    assert kept[:200].all() and not kept[250] and kept[200:250].sum() <= 2


def test_sparse_marks_are_the_matrix():
    rng = np.random.default_rng(2)
    x = (rng.random((40, 7)) < 0.3).astype(float)
    marks = toxicity.Marks(*np.nonzero(x), x.shape)
    a, b = rng.random(7), rng.random(40)
    assert np.allclose(marks @ a, x @ a) and np.allclose(marks.T @ b, x.T @ b)
