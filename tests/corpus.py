"""A random corpus with copies, frequent words, odd environments and degenerate reports."""

import random

from tests.direct import case, report

PLATFORMS = ["Python", "Spark 100%", "Azure_SDK", "Data (Lake)", None, "R"]


def corpus(seed, size=150):
    rng = random.Random(seed)
    rare = [f"term{i}" for i in range(400)]
    common = ["alpha", "beta", "gamma", "delta"]

    def sentence(most):
        body = rng.choices(common, k=rng.randint(1, 6)) + rng.choices(rare, k=rng.randint(0, most))
        return " ".join(body)

    kb = [
        case(
            i,
            sentence(6),
            rng.choice(PLATFORMS),
            rng.choice(["class work", "Notebook", "", None]),
            rng.sample(["one", "two", "three"], rng.randint(0, 3)),
            sentence(30),
            [sentence(4) for _ in range(rng.randint(0, 2))],
        )
        for i in range(size)
    ]
    # a third of the cases are copies of one short case that matches the common words best
    hot = case(0, "alpha beta", "Python", "Notebook", ["one"], "gamma")
    for i in rng.sample(range(size), size // 3):
        kb[i] = {**hot, "kb_id": i, "source_url": f"doc://{i}"}
    environments = ["", None, " python\t", "SPARK 100%", "%", "_", "(", "two three", "nowhere", "r"]
    reports = [
        report(i, sentence(10), environments[i % len(environments)], "alpha", sentence(3))
        for i in range(30)
    ]
    reports += [
        report(30, "alpha"),
        report(31, "   ", None, None, None),
        report(32, "the and of", "Python"),
        report(33, "unknownword anotherone", "r"),
        report(34, "alpha beta gamma delta", "python"),
    ]
    # a third of the reports are the same text
    reports += [report(100 + i, "alpha beta term1 term2") for i in range(17)]
    rng.shuffle(kb)
    return kb, reports
