"""Splitting a text into words and a word into pieces, as two public vocabularies ask for it.

Plain Python used inside tasks by the encoding and the counting operator.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import regex

NEVER = sys.maxsize  # rank of a pair that no merge joins

# Above this many symbols a word is merged through a heap; both ways give the same pieces.
SHORT = 128


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next free one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def merge_short(word: str, cuts: list[int], ranks_of: dict[tuple[str, str], int]) -> list[int]:
    """Boundaries of the pieces of a word.

    ``cuts`` holds the part boundaries and ``ranks`` the rank of each part with its right neighbour, both contiguous.
    The lowest rank (the leftmost of equal ones) is looked for again and again; its inner boundary is deleted and the
    two ranks beside it are renewed.
    """
    rank = ranks_of.get
    ranks = [rank((word[a:b], word[b:c]), NEVER) for a, b, c in zip(cuts, cuts[1:], cuts[2:])]
    while ranks:
        low = min(ranks)
        if low == NEVER:
            break
        i = ranks.index(low)
        del cuts[i + 1], ranks[i]
        a, b = cuts[i], cuts[i + 1]
        part = word[a:b]
        if i < len(ranks):
            ranks[i] = rank((part, word[b : cuts[i + 2]]), NEVER)
        if i:
            ranks[i - 1] = rank((word[cuts[i - 1] : a], part), NEVER)
    return cuts


def merge_long(word: str, cuts: list[int], ranks_of: dict[tuple[str, str], int]) -> list[int]:
    """The same boundaries for a very long word, in n log n steps."""
    n = len(cuts) - 1
    after, before, live = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
    end = cuts[1:]
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks_of.get((word[cuts[i] : end[i]], word[cuts[j] : end[j]]), NEVER)) != NEVER:
            heapq.heappush(queue, (r, i, end[i], end[j]))

    for i in range(n):
        offer(i)
    while queue:
        _, i, mid, stop = heapq.heappop(queue)
        if not live[i] or end[i] != mid or (j := after[i]) >= n or end[j] != stop:
            continue
        live[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [cuts[i] for i in range(n) if live[i]] + [cuts[n]]


@functools.cache
def told_apart() -> frozenset[str]:
    """Characters that the two regular-expression modules sort differently."""
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    differ: set[str] = set()
    for fast, exact in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s")):
        differ |= set(re.findall(fast, every)) ^ set(regex.findall(exact, every))
    return frozenset(differ)


class Words:
    """Finds the words of a text. ``odd`` is what `told_apart` found, where that is known already."""

    # The two patterns as the vocabulary files state them.
    SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    BARE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, spaced: bool, odd: frozenset[str] | None = None):
        self.exact = regex.compile(self.SPACED if spaced else self.BARE)
        # The built-in module is four times as fast; its classes differ only for the characters in `odd`.
        self.fast = re.compile(
            r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
            if spaced
            else r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
        )
        self.odd = told_apart() if odd is None else odd
        low = "".join(map(re.escape, sorted(c for c in self.odd if c < "\u0250")))
        self.suspect = re.compile(f"[{low}\u0250-\U0010ffff]")  # all of them, and more, found at little cost

    def __call__(self, text: str) -> list[str]:
        exact = self.suspect.search(text) and not self.odd.isdisjoint(text)
        return (self.exact if exact else self.fast).findall(text)


def file_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class WordPieces:
    """A byte-level vocabulary with merges, read from a tokenizer file.

    Two files are understood: words with an end mark, of a lower-cased text without white space; and words that carry
    their leading space, of the text as it is.
    """

    def __init__(self, path: str):
        self._build(file_text(path))

    @classmethod
    def of(cls, text: str, odd: frozenset[str] | None = None) -> WordPieces:
        """The vocabulary in the text of a tokenizer file."""
        made = cls.__new__(cls)
        made._build(text, odd)
        return made

    def _build(self, text: str, odd: frozenset[str] | None = None) -> None:
        spec = json.loads(text)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(map(tuple, model["merges"]))}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.lowered = spec["normalizer"] is not None
        self.words = Words(not self.lowered, odd)
        self.letters = byte_letters()
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def split(self, text: str) -> Iterator[str]:
        """Stretches between special strings, and those strings."""
        return iter(self.marks.split(text)) if any(map(text.__contains__, self.special)) else iter((text,))

    def plain(self, text: str) -> str:
        """The text as its words are looked for."""
        if not self.lowered:
            return text
        text = unicodedata.normalize("NFC", text)
        # Letter by letter: a capital sigma at the end of a word is not special here.
        return text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))

    def pieces(self, word: str) -> list[int]:
        """Ids of the pieces of one word; a letter that the vocabulary lacks is left out."""
        shown = "".join(map(self.letters.__getitem__, word.encode("utf-8")))
        n = len(shown)
        if self.end:
            shown += self.end
        cuts = [*range(n), len(shown)]
        cuts = (merge_short if n <= SHORT else merge_long)(shown, cuts, self.ranks)
        return [i for a, b in zip(cuts, cuts[1:]) if (i := self.ids.get(shown[a:b])) is not None]
