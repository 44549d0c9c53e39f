"""The operators' definitions on plain Python values, for comparison."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def lower(text):
    return text.translate(UPPER)


def contamination(docs, items):
    grams = {}
    for item, text in items:
        w = WORD.findall(lower(text or ""))
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = WORD.findall(lower(text or "")), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (items_of := grams.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found.update(items_of - {None})
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def base_counts(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, repeated, len(covered), failed


def without_repeats(docs, size=35):
    words = [SPACE_WORD.findall(text or "") for _, text in docs]
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = {i + k for i in range(len(w) - size + 1) if times[tuple(w[i : i + size])] > 1 for k in range(size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text):
    w = SPACE_WORD.findall(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(docs):
    prints = [(doc, fingerprint(text)) for doc, text in docs]
    name = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, x) in enumerate(prints):
            for j, (_, y) in enumerate(prints):
                if name[i] != name[j] and (x ^ y).bit_count() <= 2:
                    name[i] = name[j] = min(name[i], name[j])
                    changed = True
    ids = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            ids[name[i]] = min(ids.get(name[i], doc), doc)
    return [(doc, f"{x:016x}", ids.get(name[i])) for i, (doc, x) in enumerate(prints)]


def token_files(docs, encode):
    out, start = [], 0
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    for doc, text in order:
        ids = encode(text or "") + [2]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc, start, len(ids), zlib.crc32(data)))
        start += len(ids)
    return out


def lines(docs):
    last = 1 << 62
    key = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    held = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(last if doc is None else doc)
    out = []
    for doc, text in docs:
        parts = (text or "").split("\n")
        own = last if doc is None else doc
        kept = [x for x in parts if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == own]
        out.append((doc, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def records(pages):
    first = {}
    for page, html in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in pages:
        data = (html or "").encode()
        of = first.get(html or "")
        revisit = len(data) >= 100 and of is not None and of != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return out


def divergences(docs):
    """Rows of (doc_id, lang, source, text)."""
    texts = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))) for _, lang, source, text in docs]
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x for x, *_ in texts}:
        mine = [(s, w) for x, s, w in texts if x == lang]
        held = Counter(t for _, w in mine for t in set(w))
        kept = sorted(t for t, n in held.items() if n >= 10)

        def shares(words):
            counts = Counter(words)
            total = sum(counts[t] for t in kept)
            return counts, {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares([t for _, w in mine for t in w])[1]
        groups = {s: shares([t for x, w in mine if x == s for t in w]) for s in {s for s, _ in mine}}
        for source, (counts, p) in groups.items():
            pairs = [(-sum(f(p[t], q[t]) for t in kept), other.encode(), other) for other, (_, q) in groups.items() if other != source]
            terms = [(-f(p[t], whole[t]), t.encode(), t) for t in kept if counts[t] and p[t] > whole[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, source, part, item, -value, i + 1) for i, (value, _, item) in enumerate(rows)]
    return out
