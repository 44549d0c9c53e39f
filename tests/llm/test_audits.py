"""Source divergence, language and alignment against their definitions in plain Python."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseweave.llm import alignment, divergence, language
from caseweave.llm.common import table
from caseweave.workspace import new_folder
from tests.llm import plain
from tests.llm.test_operators import same

FOLDER = "/root/testdata/sf0.001"


def stored(spark, rows, schema):
    """As a table with extra columns that operators might use themselves."""
    df = spark.createDataFrame(rows, schema)
    more = ["term", "n", "p", "q", "shard", "item", "value", "rank", "block", "key", "code", "piece", "symbols"]
    path = new_folder(spark, "docs")
    df.withColumns({x: F.lit("x") for x in more}).write.parquet(path)
    return spark.read.parquet(path)


# divergence

random.seed(3)
TERMS = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["été", "日本", "The"]


def awkward_sources():
    rows = [(1, None, None, None), (2, "en", None, ""), (3, None, "s", "12 34"), (4, "xx", "a", "few words"), (4, "xx", "b", "few words")]
    for i in range(150):
        lang, source = random.choice(["en", "en", "de", ""]), random.choice(["a", "a", "a", "b", "é", None, "c,d"])
        text = " ".join(random.choices(TERMS, k=random.randint(0, 40)))
        rows.append((i % 100 if i % 7 else None, lang, source, text.upper() if i % 5 == 0 else f"1{text}_x."))
    rows.append((200, "en", "long", " ".join(random.choices(TERMS, k=40_000))))
    rows += [(300 + i, "en", "copies", "the same words again") for i in range(30)]
    rows += [(400 + i, "ties", f"s{i % 3}", "alpha beta gamma") for i in range(12)]
    rows += [(500, "en", "nothing", "..."), (501, "one", "only", "a b")]
    return rows


@pytest.mark.parametrize("shard", [divergence.SHARD, 50])
@pytest.mark.parametrize("rows", ["awkward", "table", "empty"])
def test_divergence(spark, rows, shard, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD", shard)
    if rows == "table":
        read = table(spark, FOLDER, "documents").select("doc_id", "lang", "source", "text")
        rows = [tuple(r) for r in read.collect()]
    else:
        rows = awkward_sources() if rows == "awkward" else []
    docs = stored(spark, rows, "doc_id long, lang string, source string, text string")
    same(divergence.divergences(docs), plain.divergences(rows))


def test_accumulated_rows_are_the_dense_sums():
    rng = np.random.default_rng(5)
    count = rng.integers(0, 4, (7, 90))
    p = 1 + 10**9 * (count + 2) // (count.sum(1) + 180)[:, None]
    zero = 1 + 10**9 * 2 // (count.sum(1) + 180)
    group, term = np.nonzero(count)
    found = list(divergence.scattered(group, term, p[group, term], zero, 90))
    dense = ((p[:, None] - p[None]) ** 2 // (p[:, None] + p[None])).sum(2)
    assert np.array_equal(np.array(found), dense)


# language


def phrases(text, pieces):
    n = i = 0
    while i < len(text):
        k = 0
        while i + k < len(text) and any(text[i : i + k + 1] in x for x in pieces):
            k += 1
        n += 1
        i += max(k, 1)
    return n


def test_phrases_are_the_longest_matches(monkeypatch):
    monkeypatch.setattr(language, "STRETCH", 7)
    random.seed(11)
    draw = lambda n: "".join(random.choices("ab cé", k=n))
    references = {x: [draw(40).encode() for _ in range(4)] for x in ("one", "two", "three")}
    references["two"].append("größe".encode())
    texts = ["", "a", "zzz", "ab", "größe zé", *[draw(random.randint(1, 60)) for _ in range(60)]]
    texts.append(draw(5_000))
    parser = language.CrossParser(references)
    coded = [x.encode() for x in texts]
    cut = lambda x: [x[i : i + 7] for i in range(0, len(x), 7)]
    expected = [[sum(phrases(y, references[name]) for y in cut(x)) for name in parser.languages] for x in coded]
    assert parser.phrases(pa.array(coded, pa.binary())).tolist() == expected
    assert parser.phrases(pa.array([b"x", *coded], pa.binary())[1:]).tolist() == expected


def test_references_are_bounded(monkeypatch):
    monkeypatch.setattr(language, "CELLS", 2_000)
    parser = language.CrossParser({"a": [b"abcdefgh" * 50] * 9, "b": [b"xyz " * 100]})
    assert len(parser.steps) <= 2_000


def test_symbols():
    texts = pa.array(["Ein  Straßen-Wort.", "", "12", "ÉTÉ\n\nx"])
    assert [x.decode() for x in language.symbols(texts).to_pylist()] == [" ein straßen wort ", "  ", "  ", " été x "]


@pytest.fixture(scope="module")
def spoken(spark):
    random.seed(17)
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["strz", "chl", "ow"], "cc": ["日本", "語", "文"]}
    rows = []
    for i in range(240):
        lang = random.choice([*sounds])
        text = " ".join("".join(random.choices(sounds[lang], k=random.randint(2, 4))) for _ in range(30))
        rows.append((i, lang if i % 9 else None, text if i % 11 else text.upper()))
    rows += [(None, "aa", "kato"), (1000, "dd", None), (1001, "dd", "1234"), (1002, "aa", ""), (5, "aa", "kato mito")]
    rows += [(2000, "aa", "kato tomi " * 20_000), *[(3000 + i, "aa", "kakaka kato") for i in range(50)]]
    return rows


def test_language(spark, spoken):
    docs = stored(spark, spoken, "doc_id long, lang string, text string")
    references = language.fit(docs)
    assert sorted(references) == ["aa", "bb", "cc"]
    found = language.predicted(docs, references)
    assert found.count() == len(spoken)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.doc_id, []).append(r)
    for doc, lang, text in spoken:
        out = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 3 == 1
        assert all(r.held_out == out(doc) and 0 <= r.score <= 1 for r in rows[doc])
        if not any(c.isalpha() for c in text or ""):
            assert [(r.lang_pred, r.score) for r in rows[doc]] == [("und", 0.0)]
    truth = {d: x for d, x, t in spoken if x and t and any(map(str.isalpha, t))}
    assert all(rows[d][0].lang_pred == x for d, x in truth.items())


def test_held_out_documents_teach_nothing(spark):
    rows = [(i, "aa", f"w{'abcdefghij'[i % 10]} " * 40) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    changed = spark.createDataFrame(
        [(i, "zz" if i in held else x, "other text" if i in held else t) for i, x, t in rows], docs.schema
    )
    assert language.fit(docs) == language.fit(changed) and held


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, None, "some text"), (2, None, None)], "doc_id long, lang string, text string")
    found = language.predicted(docs, language.fit(docs))
    assert {(r.doc_id, r.lang_pred, r.score) for r in found.collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert language.predicted(docs.limit(0), language.fit(docs.limit(0))).count() == 0


def test_one_language_wins_with_score_one(spark):
    docs = spark.createDataFrame([(i, "aa", "some text here") for i in range(9)], "doc_id long, lang string, text string")
    assert {(r.lang_pred, r.score) for r in language.predicted(docs, language.fit(docs)).collect()} == {("aa", 1.0)}


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    found = language.predicted(docs, language.fit(docs)).where("held_out")
    known = docs.select("doc_id", "lang").where("lang is not null")
    right = found.join(known, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99


# alignment

ODD = [
    (1, None), (2, ""), (3, " "), (4, "   a  b "), (5, "▁x"), (6, "<|endoftext|> a<s></s><unk> <0x41>"),
    (7, "日本 🎉 é é"), (8, "\x00a\x01\n\n\tb"), (8, "a" * 3000), (None, " x y z"), (None, "x"), (9, "one"),
    (10, "naïve ÉTÉ straße \x85 x y"), (11, "   "), (12, " " * 5000), (13, "one"), (14, "one two\r\none"),
    (15, "word " * 30_000),
]


@pytest.fixture(scope="module")
def both_tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.tokenizer_path())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=alignment.pieces_path())


def spelt(tools, text):
    a, b = tools
    shown = {c: i for i, c in alignment_bytes().items()}
    ids = a.encode(" " + text, add_special_tokens=False).ids
    pieces = b.encode(text)
    of_a = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids]
    of_b = [bytes.fromhex(x[3:5]) if b.is_byte(i) else x.replace("▁", " ").encode() for i, x in zip(pieces, map(b.id_to_piece, pieces))]
    whole = f" {text}".encode()
    return (ids, pieces, of_a, of_b) if b"".join(of_a) == b"".join(of_b) == whole else ([], [], [], [])


def alignment_bytes():
    """Bytes and the characters that show them: printable ones as they are, the others from 256."""
    out, other = {}, 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out[b] = chr(b)
        else:
            out[b] = chr(other)
            other += 1
    return out


def plain_alignments(docs, tools):
    rows, held = [], Counter()
    for doc, text in docs:
        ids, pieces, of_a, of_b = spelt(tools, text) if text else ([], [], [], [])
        a_ends, b_ends = [*accumulate(map(len, of_a))], [*accumulate(map(len, of_b))]
        ends = sorted({*a_ends} & {*b_ends})
        groups = [([], []) for _ in ends]
        for side, some, at in ((0, ids, a_ends), (1, pieces, b_ends)):
            for x, g in zip(some, np.searchsorted(ends, at)):
                groups[g][side].append(x)
        links = Counter()
        for a, b in groups:
            times_b = Counter(b).items()
            for x, m in Counter(a).items():
                for y, n in times_b:
                    links[x, y] += m * n
        held.update(links.keys())
        rows.append((doc, ids, pieces, groups, links))
    highest = {}
    for (x, _), n in held.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for doc, ids, pieces, groups, links in rows:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(n for k, n in links.items() if held[k] == highest[k[0]])
        total = sum(n * held[k] for k, n in links.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if ids else ""
        out.append((doc, len(ids), len(pieces), len(groups), links.total(), best, total, digest))
    return out


@pytest.mark.parametrize("rows", ["odd", "table", "empty"])
def test_alignment(spark, rows, both_tokenizers, monkeypatch):
    if rows == "table":
        read = table(spark, FOLDER, "documents").select("doc_id", "text")
        rows = [tuple(r) for r in read.collect()]
    else:
        rows = ODD if rows == "odd" else []
    docs = stored(spark, rows, "doc_id long, text string")
    same(alignment.alignments(docs), plain_alignments(rows, both_tokenizers))


@pytest.mark.parametrize("wide", [alignment.WIDE, 1])
def test_blocks(both_tokenizers, monkeypatch, wide):
    monkeypatch.setattr(alignment, "WIDE", wide)
    tools = alignment.tokenizers(alignment.tokenizer_path(), alignment.pieces_path())
    texts = pa.array([t or "" for _, t in ODD])
    for a, b in [(0, len(ODD)), (3, 9), (9, len(ODD))]:
        block = alignment._block(tools, 0, pa.array(range(b - a)), texts[a:b])
        expected = plain_alignments(ODD[a:b], both_tokenizers)
        assert block["digests"] == [x[-1] for x in expected]
        assert block["n_links"] == [x[4] for x in expected]


def test_frequent_pairs_over_many_blocks(spark, both_tokenizers):
    rows = [(i, f"the common words and n{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    path = new_folder(spark, "docs")
    docs.write.parquet(path)
    same(alignment.alignments(spark.read.parquet(path)), plain_alignments(rows, both_tokenizers))


def test_pairs_travel_packed(spark, both_tokenizers):
    """Rows between blocks and buckets don't grow with the distinct pairs of a block."""
    random.seed(9)
    names = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(4000)]
    rows = [(i, " ".join(random.choices(names, k=50))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    blocks = alignment.aligned(docs)
    counts = alignment.pair_counts(blocks).collect()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(counts) <= blocks.count() * buckets
    held = Counter()
    for row in blocks.select("keys", "docs").collect():
        held.update(dict(zip(row["keys"], row["docs"])))
    highest = Counter()
    for key, n in held.items():
        highest[key >> 32] = max(highest[key >> 32], n)
    for row in counts:
        keys, found = np.frombuffer(row["keys"], np.int64).tolist(), np.frombuffer(row["counts"], np.int64).tolist()
        assert found == [held[k] for k in keys]
        assert [*map(bool, row["best"])] == [held[k] == highest[k >> 32] for k in keys]
