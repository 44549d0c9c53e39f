"""Column expressions for text: trimming, lines, tokens, fixed-point numbers.

Java's regular expressions and trim functions differ from the semantics the results
are defined with, so the character classes are spelled out here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace, line ends and word characters that define the results.
WHITESPACE = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
SPACE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
NO_WORD = r"[^\p{L}\p{N}_]"
SHORTEST = 2
BAG = "array<struct<term:string,tf:int>>"

#: Bytes of text that a task counts the words of at a time, and that it cuts into words at a
#: time: arrays for that much stay in the caches, and their memory is used again.
STEP = 8 << 20
CUT = 1 << 20
#: Bytes of terms that a task counts at a time, and rows that it hands over at a time.
COUNTED = 24 << 20
ROWS = 1 << 17


def english_stop_words() -> list[str]:
    """Default stop words; every scoring function takes another list instead."""
    text = resources.files("caseweave").joinpath("resources/english_stop_words.txt").read_text("utf-8")
    return [word for line in text.splitlines() if not line.startswith("#") for word in line.split()]


def fingerprint(*values: Column) -> Column:
    """128-bit key of a row of values; to_json keeps the values apart."""
    return F.unhex(F.md5(F.to_json(F.struct(*values))))


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(text, rf"\A{WHITESPACE}+|{WHITESPACE}+\z", "")


def clean(text: Column) -> Column:
    """Null becomes the empty string, then strip."""
    return strip(F.coalesce(text, F.lit("")))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def joined(items: Column, separator: str = " ") -> Column:
    """Join an array of strings; a null array gives the empty string."""
    return F.coalesce(F.array_join(items, separator), F.lit(""))


def lines(text: Column) -> Column:
    """Split at every line end; a final line end makes no extra line."""
    body = F.regexp_replace(text, rf"(?:{LINE_END})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_END))


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(text, rf"{WHITESPACE}+"), lambda token: token != "")


@lru_cache(maxsize=4)
def _splits(between: str) -> np.ndarray:
    """For every code point whether the pattern, a class of characters, matches it."""
    points = [chr(c) if not 0xD800 <= c <= 0xDFFF else " " for c in range(0x110000)]
    return pc.match_substring_regex(pa.array(points, pa.string()), between).to_numpy(zero_copy_only=False)


def _parts(texts: pa.StringArray, most: int) -> Iterator[tuple[int, pa.StringArray]]:
    """Runs of texts of about ``most`` bytes, one text at least, and where they begin."""
    size = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        used = size[at - 1] if at else 0
        stop_at = max(at + 1, int(np.searchsorted(size, used + most)))
        # a copy, so that offsets begin at zero
        yield at, pa.concat_arrays([texts.slice(at, stop_at - at), pa.array([], pa.string())])
        at = stop_at


def _words(texts: pa.StringArray, between: str, shortest: int) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts one after the other, and the text that each is from.

    Cut on the code points of all texts at once; a match of the pattern for each word takes
    several times as long.
    """
    edges = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: edges[-1]]
    first = np.flatnonzero((raw & 0xC0) != 0x80)  # where a character begins
    points = raw if len(first) == len(raw) else np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    inside = np.zeros(len(points) + 1, bool)
    inside[:-1] = ~_splits(between)[points]
    begins = np.searchsorted(first, edges)  # in characters
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[begins] = inside[begins]
    start = np.flatnonzero(starts)
    stops = inside[:-1] & (starts[1:] | ~inside[1:])
    stop = np.flatnonzero(stops) + 1
    long = stop - start >= shortest
    start, stop = start[long], stop[long]
    ends = np.append(first, len(raw))
    size = ends[stop] - ends[start]
    # the bytes of the words alone
    steps = np.zeros(len(raw) + 1, np.int8)
    steps[ends[start]] += 1
    steps[ends[stop]] -= 1
    kept = raw[np.cumsum(steps[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(kept))
    return found, np.searchsorted(begins, start, "right") - 1


def _counted(texts: pa.StringArray, between: str, shortest: int, stop: pa.Array):
    """(words, place, tf, edges): the distinct words of each text, in order, and their counts."""
    cut = [(at, _words(part, between, shortest)) for at, part in _parts(texts, CUT)]
    words = pa.concat_arrays([x for _, (x, _) in cut])
    of = np.concatenate([at + x for at, (_, x) in cut])
    coded = words.dictionary_encode()
    names = coded.dictionary
    order = pc.sort_indices(names).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    names = names.take(pa.array(order))
    wanted = pc.invert(pc.is_in(names, value_set=stop)).to_numpy(zero_copy_only=False)
    word = place[coded.indices.to_numpy(zero_copy_only=False)]
    some = wanted[word]
    size = max(len(names), 1)
    entry, tf = np.unique((of * size + word)[some], return_counts=True)
    of, at = np.divmod(entry, size)
    return names.take(pa.array(at)), tf.astype(np.int32), np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)


def _as_bags(words: pa.StringArray, tf: np.ndarray, edges: np.ndarray) -> list[pa.Array]:
    entries = pa.StructArray.from_arrays([words, pa.array(tf)], ["term", "tf"])
    return [pa.ListArray.from_arrays(pa.array(edges), entries)]


def _as_lists(words: pa.StringArray, tf: np.ndarray, edges: np.ndarray) -> list[pa.Array]:
    lists = [pa.ListArray.from_arrays(pa.array(edges), x) for x in (words, pa.array(tf))]
    return [pc.binary_join(lists[0], " "), lists[1]]


def _bags(between: str, shortest: int, stop_words: list[str], names: list[str], form: Callable):
    """Turns batches whose last column is lower-cased text into such with the bag instead.

    ``between`` is a class of characters, those between words.
    """
    stop = pa.array(sorted(stop_words), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _parts(batch.columns[-1], STEP):
                kept = [x.slice(at, len(texts)) for x in batch.columns[:-1]]
                columns = form(*_counted(texts, between, shortest, stop))
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=names)

    return run


def _with_bag(df: DataFrame, text: Column, added: str, form: Callable, between: str, shortest: int, stop_words: list[str]):
    lowered = df.select("*", F.lower(F.coalesce(text, F.lit(""))).alias("lowered"))
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields])
    return lowered.mapInArrow(_bags(between, shortest, stop_words, schema.names, form), schema)


def with_term_bag(df: DataFrame, text: Column, stop_words: list[str], name: str = "bag") -> DataFrame:
    """Add ``name``: the distinct words of ``text``, lower-cased, with their counts.

    Words are runs of two or more word characters that are no stop words. The built-in
    functions cut and count words element by element outside of generated code, which takes
    ten times as long as doing it on whole batches of texts, so this is an Arrow function.
    Rows stay where they are; nothing is shuffled.
    """
    return _with_bag(df, text, f"`{name}` {BAG}", _as_bags, NO_WORD, SHORTEST, stop_words)


def with_term_lists(df: DataFrame, text: Column, stop_words: list[str]) -> DataFrame:
    """Add ``terms`` and ``tfs``: the bag with its words in order as one text, and their counts.

    Words hold no space. A text is written, read and shuffled several times faster than an
    array of as many words; ``listed_bag`` gives the bag again.
    """
    return _with_bag(df, text, "terms string, tfs array<int>", _as_lists, NO_WORD, SHORTEST, stop_words)


def listed_bag() -> Column:
    """The bag that ``with_term_lists`` made the columns of."""
    held = F.arrays_zip(F.split("terms", " "), F.col("tfs")).cast(BAG)
    return F.when(F.size("tfs") > 0, held).otherwise(F.array().cast(BAG))


def with_token_bag(df: DataFrame, text: Column, name: str = "bag") -> DataFrame:
    """Add ``name``: the distinct tokens between white space of the lower-cased ``text``."""
    return _with_bag(df, text, f"`{name}` {BAG}", _as_bags, SPACE, 1, [])


def bag_entries(df: DataFrame, *keys: str, bag: str = "bag") -> DataFrame:
    """(keys, term, tf) from a bag column.

    explode would infer a filter on the size of the bag, and pushing it down would copy the
    whole bag expression into it; the outer form has no such filter.
    """
    return (
        df.select(*keys, F.explode_outer(bag).alias("entry"))
        .filter(F.col("entry").isNotNull())
        .select(*keys, "entry.term", "entry.tf")
    )


def _held(key: str, most: int):
    """Counts how many rows of a key hold a term, over about ``most`` bytes of terms at a time."""

    def counted(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(rows).combine_chunks()
        keys = pc.dictionary_encode(rows[key]).combine_chunks()
        words = pc.split_pattern(rows["terms"], " ").combine_chunks()
        coded = words.flatten().dictionary_encode()
        size = len(coded.dictionary)
        of = np.repeat(keys.indices.to_numpy().astype(np.int64), np.diff(words.offsets.to_numpy()))
        pair, df = np.unique(of * size + coded.indices.to_numpy(), return_counts=True)
        of, at = np.divmod(pair, size)
        for i in range(0, len(pair), ROWS):
            some = slice(i, i + ROWS)
            columns = [keys.dictionary.take(pa.array(of[some])), coded.dictionary.take(pa.array(at[some]))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(df[some].astype(np.int64))], names=[key, "term", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            rows, size = [*rows, batch], size + batch["terms"].nbytes
            if size >= most:
                yield from counted(rows)
                rows, size = [], 0
        if size:
            yield from counted(rows)

    return run


def term_frequencies(lists: DataFrame, key: str) -> DataFrame:
    """(key, term, df): how many rows of a key hold a term; ``lists`` as ``with_term_lists`` gives it.

    Rows are counted together before they become rows of a table.
    """
    held = lists.filter("terms != ''").select(key, "terms")
    kind = held.schema[key].dataType.simpleString()
    counts = held.mapInArrow(_held(key, COUNTED), f"{key} {kind}, term string, df long")
    return counts.groupBy(key, "term").agg(F.sum("df").alias("df"))


def round_half_even(value: Column, places: int = 3) -> Column:
    """Round the exact binary value half to even.

    The built-in rounding works on the shortest decimal form, which moves values such as
    0.0125 the other way. The double is split in two halves whose products with the scale
    are exact, so the distance to the midpoint has the right sign.
    """
    scale = float(10**places)
    high = value * 134217729.0 - (value * 134217729.0 - value)
    low = value - high
    below = F.floor(value * scale).cast("double")
    distance = (high * scale - (below + 0.5)) + low * scale
    up = (distance > 0) | ((distance == 0) & (F.pmod(below, F.lit(2.0)) == 1))
    return (F.when(up, below + 1).otherwise(below)) / scale


def fixed_point(value: Column, places: int = 3) -> Column:
    """Text with a fixed number of decimals, rounded half to even; the sign always shows."""
    rounded = round_half_even(value, places)
    small = (value < 0) & (rounded == 0)
    return F.when(small, f"{-0.0:.{places}f}").otherwise(F.format_string(f"%.{places}f", rounded))
