import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from caseweave.functions import text
from caseweave.functions.text import (
    english_stop_words,
    fixed_point,
    lines,
    listed_bag,
    round_half_even,
    strip,
    term_frequencies,
    whitespace_tokens,
    with_term_bag,
    with_term_lists,
)
from tests.direct import words

SPACES = [chr(c) for c in range(0x11000) if not 0xD800 <= c <= 0xDFFF and chr(c).isspace()]


def test_stop_words():
    listed = english_stop_words()
    assert len(listed) == len(set(listed)) == 318


def test_strip_and_split_equal_python(spark):
    texts = [f"{s}a{s}b{s}" for s in SPACES] + ["", "  ", " ​x​ ", "a\n\n", "x  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select(
        "t", strip(F.col("t")).alias("s"), whitespace_tokens(F.col("t")).alias("w")
    ).collect():
        assert row.s == row.t.strip()
        assert row.w == row.t.split()


def test_lines_equal_python(spark):
    ends = ["\n", "\r\n", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    texts = [f"a{e}b{e}" for e in ends] + ["", "\n", "\n\n", "a\r\n\r\nb", "a\n\rb", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", lines(F.col("t")).alias("l")).collect():
        assert row.l == row.t.splitlines()


def test_term_bag(spark):
    texts = ["The Error error x xx_1 Straße élan", "", "the of", "日本 日本 a b", "don't can't 42 4"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in with_term_bag(df, F.col("t"), english_stop_words()).collect():
        found = [e.term for e in row.bag for _ in range(e.tf)]
        assert sorted(found) == sorted(words(row.t))


def test_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [0.0, 1.0, 0.0625, 0.0125, 0.0005, 0.0015, 0.0025, 0.9995, 1 / 3, -0.25, -0.0625]
    values += [n / 2000 for n in range(1, 2000, 2)] + [rng.uniform(-1, 1) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select(
        "v", round_half_even(F.col("v")).alias("r"), fixed_point(F.col("v")).alias("f")
    ).collect():
        assert row.r == round(row.v, 3)
        assert float(row.f) == float(f"{row.v:.3f}")


def odd_texts():
    """Words at the ends of texts, and characters of 1 to 4 bytes."""
    rng = random.Random(4)
    letters = ["a", "b", "_", "é", "日", "ß", " ", " ", "\x85", "1", "٣", "𝒳", "😀", "-", "\n", "\x00"]
    return ["", "the", "", *["".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(200)]]


def test_term_lists_are_the_bags(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "k int, t string")
    lists = with_term_lists(df, F.col("t"), english_stop_words())
    wanted = [Counter(words(t)) for t in texts]
    found = lists.select("t", "tfs", "terms", listed_bag().alias("bag")).collect()
    assert [(r.t, {e.term: e.tf for e in r.bag}) for r in found] == list(zip(texts, wanted))
    assert all(r.terms.split() == sorted(r.terms.split(), key=str.encode) for r in found)
    held = Counter((i % 3, term) for i, bag in enumerate(wanted) for term in bag)
    assert {(r.k, r.term): r.df for r in term_frequencies(lists, "k").collect()} == dict(held)


def test_words_do_not_depend_on_the_parts(monkeypatch):
    monkeypatch.setattr(text, "CUT", 40)
    monkeypatch.setattr(text, "STEP", 90)
    monkeypatch.setattr(text, "ROWS", 7)
    texts = [t.lower() for t in odd_texts()]
    batch = pa.RecordBatch.from_pydict({"k": [i % 3 for i in range(len(texts))], "t": texts})
    names = ["k", "terms", "tfs"]
    parts = list(text._bags(text.NO_WORD, text.SHORTEST, english_stop_words(), names, text._as_lists)([batch]))
    rows = [row for part in parts for row in part.to_pylist()]
    assert len(parts) > 10
    wanted = [Counter(words(t)) for t in texts]
    assert [dict(zip(r["terms"].split(), r["tfs"])) for r in rows] == wanted
    full = [part.filter(pc.not_equal(part["terms"], "")).select(["k", "terms"]) for part in parts]
    held = Counter()
    for part in text._held("k", 200)(full):
        assert part.num_rows <= 7
        held.update({(r["k"], r["term"]): r["df"] for r in part.to_pylist()})
    assert held == Counter((i % 3, term) for i, bag in enumerate(wanted) for term in bag)
