"""Small inputs with the awkward cases, and brute-force versions."""

from __future__ import annotations

import re

import public_tokenizers
import xxhash

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, h1 string, ids string, removed string"

TEXTS = [
    "The cat sat on the mat and looked at the dog. It's 12 o'clock!\nAnother line here.",
    None,
    "",
    " \t\n ",
    "a",
    "one two three four",
    "ΣΑΣ ΟΔΟΣ İstanbul ß É naïve x²½ Ⅷ ٣ z_a_ __  nbsp\x1cfs",
    "日本語テキスト 👍🏽 done <|endoftext|> and <|startoftext|>!",
    "ab" * 600 + " tail",
    "word " * 3000,
    "The cat sat on the mat and looked at the dog. It's 12 o'clock!\nAnother line here.",
]


def awkward(spark, texts=TEXTS):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns with names that operators use."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, 1, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [(0, texts[0], None, "s", None, 1, "x", "y", "z"), (None, texts[0], "en", "s", 3, None, None, None, None)]
    rows += [(None, None, None, None, None, None, None, None, None)] * 2 + [(3, "another text of document three", "en", "s", 1, 1, "", "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(values, linked):
    """Root of each value under a symmetric relation."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = list(parent)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if linked(a, b):
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def without_copied_runs(docs, least=50):
    """docs: (key, text) in order of precedence, keys distinct. Text without later copies of runs of `least` words."""
    lines = {k: [(p, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for p, x in enumerate((t or "").split("\n"))] for k, t in docs}
    lines = {k: [x for x in v if x[2]] for k, v in lines.items()}
    first = {}
    runs = []
    for k, _ in docs:
        v = lines[k]
        for i in range(len(v)):
            for e in range(i + 1, len(v) + 1):
                if sum(x[2] for x in v[i:e]) >= least:
                    content = tuple(x[1] for x in v[i:e])
                    runs.append((k, i, e, content))
                    first.setdefault(content, (k, i))
    gone = {k: set() for k, _ in docs}
    for k, i, e, content in runs:
        if first[content] != (k, i):
            gone[k] |= set(range(i, e))
    out = {}
    for k, t in docs:
        drop = set()
        for i in gone[k]:
            drop.add(lines[k][i][0])
            if i + 1 in gone[k]:
                drop |= set(range(lines[k][i][0], lines[k][i + 1][0]))
        out[k] = t if not drop else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in drop)
    return out


def hit_words(text, items):
    """n_words, places hit and ids of items found, for items of (id, text)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, places, found = split(text), set(), set()
    for item, content in items:
        w = split(content)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[j : j + n]:
                    places |= set(range(i, i + n))
                    found.add(item)
    return len(words), places, found
