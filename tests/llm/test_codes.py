"""Codes and automata against plain loops."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from caseweave.llm import simple8b, substrings
from caseweave.llm.automaton import SuffixAutomaton
from caseweave.llm.units import Encoder, tokenizer_path
from caseweave.llm.words import words_of


def packed(ids):
    out = []
    for b in range(0, len(ids), simple8b.BLOCK):
        block, i = ids[b : b + simple8b.BLOCK], 0
        while i < len(block):
            for selector in reversed(range(len(simple8b.LAYOUT))):
                count, bits = simple8b.LAYOUT[selector]
                if all(x < 1 << bits for x in block[i : i + count]):
                    word = selector << 60
                    for k, x in enumerate(block[i : i + count]):
                        word |= x << (bits * k)
                    out.append(word)
                    i += count
                    break
    return out


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("top", [1, 2, 50, 50_257, 1 << 31, 1 << 60])
def test_simple8b(n, top):
    random.seed(n + top)
    ids = [random.randrange(random.choice([1, 2, 16, top]) if top > 16 else top) for _ in range(n)]
    words, counts = simple8b.encode(np.array(ids, np.uint64))
    assert words.tolist() == packed(ids)
    assert simple8b.decode(words, counts, n).tolist() == ids


def test_simple8b_bound():
    with pytest.raises(ValueError):
        simple8b.encode(np.array([1 << 60], np.uint64))


def test_matching_statistics():
    random.seed(2)
    for _ in range(200):
        sequences = [[random.randrange(3) for _ in range(random.randrange(12))] for _ in range(3)]
        known = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [random.randrange(4) for _ in range(25)]
        expected = [
            max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in known), default=0) for i in range(len(text))
        ]
        assert SuffixAutomaton(sequences).matches(text) == expected


@pytest.mark.parametrize("shard", [1, 40, 10_000])
def test_covered_words_in_any_shards(shard):
    random.seed(4)
    texts = [" ".join(random.choices("abcdef", k=60)) for _ in range(6)]
    others = [texts[0][10:70], texts[1], "x " + texts[2][:40], texts[3][60:]]
    covered = substrings.covered_words(words_of(pa.array(texts + others)), len(texts), shard, 8)
    runs = {tuple(o.split()[i : i + 8]) for o in others for i in range(len(o.split()) - 7)}
    expected = []
    for text in texts:
        w = text.split()
        gone = {i + k for i in range(len(w) - 7) if tuple(w[i : i + 8]) in runs for k in range(8)}
        expected += [i in gone for i in range(len(w))]
    assert covered.tolist() == expected


def test_ids_are_those_of_whole_texts():
    random.seed(6)
    tool = Encoder(tokenizer_path(), most=300)
    parts = ["a", "word", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "é", "1", "\x1c", "\x85", "　", "!", "\0", "日本", "'", "\r\n", "​"]
    texts = ["".join(random.choices(parts, k=random.randrange(14))) for _ in range(3000)]
    ids, counts = tool.texts(pa.array(texts))
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        assert ids[end - n : end].tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lead", ["", " "])
def test_ids_after_units_were_forgotten(lead):
    random.seed(7)
    tool = Encoder(tokenizer_path(), most=3000)
    names = ["".join(random.choices("abcdefghij", k=random.randint(1, 9))) for _ in range(6000)]
    for _ in range(6):
        # heads of texts and texts cut again name units that are pieces as well
        texts = [" ".join(random.choices(names, k=random.randint(1, 30))) + random.choice(["", "  x", " \n x"]) for _ in range(100)]
        texts += [text.replace(" ", "  ", 1) for text in texts]
        ids, counts = tool.texts(pa.array(texts), lead)
        assert len(tool.known) == len(tool.counts)
        ends = np.cumsum(counts)
        for text, n, end in zip(texts, counts, ends):
            assert ids[end - n : end].tolist() == tool.tokenizer.encode(lead + text, add_special_tokens=False).ids


def test_neighbouring_windows_have_one_sender():
    """Three blocks hold one passage: it travels in few pieces, and not all from one block."""
    bins, shared = 4, " ".join(f"w{i}" for i in range(3000))
    docs = {b: pa.table({"block": [b, b], "text": [f"own{b} words", shared]}) for b in range(3)}
    sent = pa.concat_tables([substrings._sent(bins)(x) for x in docs.values()])
    asked = pa.concat_tables([substrings._asked(sent.filter(pc.equal(sent["bin"], i))) for i in range(bins)])
    pieces = [substrings._passages(bins)(x, asked.filter(pc.equal(asked["block"], b))) for b, x in docs.items()]
    assert sum(x.num_rows for x in pieces) < 300
    words = [pc.sum(pc.count_substring(x["passage"], " ")).as_py() or 0 for x in pieces]
    assert max(words) < sum(words) < 2 * 3 * 3000
