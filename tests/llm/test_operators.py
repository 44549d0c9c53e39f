"""Every operator against its definition, on awkward rows and on a given table."""

import random

import pytest
from pyspark.sql import functions as F

from caseweave.llm import decontaminate, lines, quality, simhash, substrings, token_counts, token_files, toxicity, units, warc
from caseweave.workspace import new_folder, written
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"
random.seed(7)
VOCABULARY = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(random.choices(VOCABULARY, k=60))
LONG = " ".join(random.choices(VOCABULARY, k=30_000))
ITEM = " ".join(random.choices(VOCABULARY, k=14))


def awkward_documents():
    texts = [None, "", "   \n\t ", "one", "one two", "A b C d E f G h I j K", "\n\n", "naïve ÉTÉ straße \x85 x y"]
    texts += [LONG, LONG, LONG + " tail", PASSAGE, PASSAGE.upper(), f"x {PASSAGE} y", f"z {PASSAGE}"]
    texts += [f"{ITEM} and more", ITEM.replace(" ", ", "), "five words of an item", "say five words of an item here"]
    texts += ["a shared line here\nown %d" % i for i in range(5)] + ["A SHARED line here  \n\ta shared line here"] * 2
    texts += ["repeat me now and then " * 12, "#*$%&|<> ## x", "<|endoftext|> a <|endoftext|>b", "  two  spaces \n in  it "]
    texts += [" ".join(random.choices(VOCABULARY, k=120)) for _ in range(20)]
    texts += [t.replace("w7 ", "w8 ", 1) for t in texts[-10:]]
    rows = list(enumerate(texts))
    return rows + [(3, "one"), (3, "another text of the same id"), (None, "one"), (None, "without an id"), (None, "without an id")]


def frame(spark, rows, name="doc_id", text="text"):
    """Extra columns have the names that operators use themselves."""
    extra = ["hits", "row", "block", "rank", "text_hash", "w", "words", "fp"]
    schema = f"{name} long, {text} string, " + ", ".join(f"{x} string" for x in extra)
    return spark.createDataFrame([(*r, *([None] * len(extra))) for r in rows], schema)


def table_rows(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*columns).collect()]


def same(df, expected):
    key = lambda row: tuple((x is not None, x) if not isinstance(x, bool) else (True, int(x)) for x in row)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


@pytest.fixture(scope="module", params=["awkward", "table", "empty"])
def documents(request, spark):
    if request.param == "empty":
        return []
    return awkward_documents() if request.param == "awkward" else table_rows(spark, "documents", "doc_id", "text")


@pytest.fixture
def docs(spark, documents):
    df = frame(spark, documents)
    path = new_folder(spark, "docs")
    df.write.parquet(path)
    return spark.read.parquet(path)


ITEMS = [(1, ITEM), (2, ITEM), (3, "five words of an item"), (10, None), (11, "..."), (None, PASSAGE[:80]), (1, "one")]


def digest(found):
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(ids, 256), F.col("n_hit") > 0
    )


def test_contamination(spark, documents, docs):
    benchmark = frame(spark, ITEMS, "item_id")
    same(digest(decontaminate.contamination(docs, benchmark)), plain.contamination(documents, ITEMS))


def test_contamination_of_nothing(spark, documents, docs):
    found = decontaminate.contamination(docs, frame(spark, [], "item_id"))
    assert found.where("n_hit > 0").count() == 0
    assert found.count() == len(documents)


def test_contamination_without_broadcast(spark, documents, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1 << 10)
    found = decontaminate.contamination(docs, frame(spark, ITEMS, "item_id"))
    same(digest(found), plain.contamination(documents, ITEMS))


def test_contaminated_rows_go(spark, documents, docs):
    clean = decontaminate.without_contaminated(docs, frame(spark, ITEMS, "item_id"))
    assert clean.columns == docs.columns
    hit = [x[5] for x in plain.contamination(documents, ITEMS)]
    same(clean.select("doc_id", "text"), [d for d, h in zip(documents, hit) if not h])


def test_spans_go(spark):
    text = f"Start: {ITEM.upper()}!  end."
    docs = frame(spark, [(1, text), (2, None), (3, "? one, five words"), (4, "nothing here")])
    cut = decontaminate.without_spans(docs, frame(spark, ITEMS, "item_id"))
    same(cut.select("doc_id", "text"), [(1, "Start: end."), (2, None), (3, "? five words"), (4, "nothing here")])


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(units.tokenizer_path())


def test_token_counts(documents, docs, tokenizer):
    size = lambda x: len(tokenizer.encode(x or "", add_special_tokens=False).ids)
    same(token_counts.token_counts(docs), [(d, len((x or "").encode()), size(x)) for d, x in documents])


def test_base_counts(documents, docs):
    nothing = quality.Model(quality.np.zeros(quality.BUCKETS), 0.0)
    judged = quality.judge(docs, nothing)
    expected = [(d, *plain.base_counts(x), not plain.base_counts(x)[-1]) for d, x in documents]
    same(judged.drop("score"), expected)


def test_repeats(documents, docs):
    kept = substrings.without_repeats(docs)
    same(kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)), plain.without_repeats(documents))


def test_shared_lines(documents, docs):
    kept = lines.without_shared_lines(docs)
    same(kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)), plain.lines(documents))


def test_fingerprints_and_components(documents, docs):
    found = simhash.near_copies(docs)
    same(
        found.select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id"),
        plain.components(documents),
    )


def test_one_of_each_component_stays(documents, docs):
    kept = simhash.keep_one(docs, simhash.near_copies(docs))
    assert kept.columns == docs.columns
    prints = {(d, x or ""): f for (d, x), (_, f, _) in zip(documents, plain.components(documents))}
    linked = {f: f for f in prints.values()}
    for a in linked:
        for b in linked:
            if linked[a] != linked[b] and (int(a, 16) ^ int(b, 16)).bit_count() <= 2:
                old, new = linked[a], linked[b]
                linked = {f: new if c == old else c for f, c in linked.items()}
    ids = {}
    for (d, _), f in prints.items():
        ids.setdefault(linked[f], []).append(d)
    least = [min(x, key=lambda d: (d is None, d or 0)) for x in ids.values()]
    found = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted((d is None, d or 0) for d, _ in found) == sorted((d is None, d or 0) for d in least)
    assert len({linked[prints[r]] for r in found}) == len(found)


def test_repeated_doc_ids_lose_no_text(spark):
    texts = [" ".join(random.choices(VOCABULARY, k=80)) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[0]), (None, texts[1]), (1, texts[0])]
    docs = frame(spark, rows)
    same(simhash.keep_one(docs, simhash.near_copies(docs)).select("doc_id", "text"), [(1, texts[0]), (1, texts[1]), (2, texts[2])])


def test_token_files(spark, documents, docs, tokenizer):
    encode = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    files = token_files.write_tokens(docs, new_folder(spark, "tokens"))
    read = token_files.read_tokens(spark, files)
    same(read.drop("ids"), plain.token_files(documents, encode))
    texts = {}
    for doc, text in documents:
        texts.setdefault(doc, []).append(encode(text or "") + [2])
    assert all(list(r.ids) in texts[r.doc_id] for r in read.select("doc_id", "ids").collect())


PAGES = [(1, "a" * 100), (2, "a" * 100), (3, "b" * 99), (4, "b" * 99), (5, None), (6, ""), (None, "a" * 100), (None, "c" * 200), (2, "a" * 100), (7, "é" * 50), (8, "é" * 50)]


@pytest.mark.parametrize("pages", [PAGES, [], None])
def test_records(spark, pages):
    pages = table_rows(spark, "pages", "page_id", "html") if pages is None else pages
    rows = [(i, f"http://x/{i}\r\nWARC-Type: other" if i else None, html) for i, html in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    archive = warc.write_archive(df, new_folder(spark, "archive"))
    same(warc.read_index(spark, archive).drop("url"), plain.records(pages))
    found = warc.read_records(spark, archive)
    same(found.select("page_id", F.col("payload").cast("string")), [(i, html or "") for i, html in pages])
    for r in found.collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and body.endswith(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert len(body) == length + 4
        assert body[:-4] == (b"" if r.record_type == "revisit" else bytes(r.payload))
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == len({html or "" for _, html in pages})


def test_damaged_payload_is_noticed(spark):
    df = spark.createDataFrame([(1, "u", "some html")], "page_id long, url string, html string")
    archive = warc.write_archive(df, new_folder(spark, "archive"))
    stored = spark.read.parquet(f"{archive}/payloads")
    other = new_folder(spark, "archive")
    stored.withColumn("payload", F.lit(b"changed")).write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_index(spark, other).collect()


def test_long_lists_link_the_same_components(spark, monkeypatch):
    """Fingerprints around one centre, so that lists are long, and the way without pairs."""
    prints = [0] + [1 << i for i in range(64)] + [3 << i for i in range(0, 62, 3)]
    prints += [(1 << 63) - 1, (0xF0F0 << 16) + 7, (0xF0F0 << 16) + 4]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in prints]
    entries = spark.createDataFrame([(x,) for x in signed], "fp long")

    def groups(edges):
        found = simhash.component_roots(edges).collect()
        by_root = {}
        for r in found:
            by_root.setdefault(r.root, set()).add(r.a)
        return sorted(map(sorted, by_root.values()))

    short = groups(simhash.links(entries))
    monkeypatch.setattr(simhash, "LIST", 1)
    assert groups(simhash.links(entries)) == short
    assert [len(x) for x in short] == [86, 2]


def test_empty_model_of_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.severity(docs, model)
    assert found.where("toxic OR expected_severity <> 0").count() == 0
    assert found.count() == docs.count()
    assert toxicity.without_toxic(docs, model).count() == docs.count()


def test_quality_labels_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(quality, "written", recorded)
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(20)], "doc_id long, text string")
    quality.fit(docs, spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int"))
    assert "SortMergeJoin" in plans["scores"] and "Broadcast" not in plans["scores"]
