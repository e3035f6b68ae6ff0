"""Splitting texts into the pre-tokens of byte-level BPE vocabularies."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import islice

import regex
from tokenizers.pre_tokenizers import ByteLevel

from muster.llm.workers import worker_held

# Pre-tokens that are held at once for a very long text.
CHUNK = 1 << 18
STAND_IN = "\ue000"


def _unknown_letters() -> regex.Pattern:
    """Code points that the regex module takes for letters or numbers, and the tokenizer libraries don't.

    Their Unicode tables are of different age. Only what Python's own table doesn't know is asked about.
    """
    library = ByteLevel(add_prefix_space=False, use_regex=True)
    odd = []
    for kind, base in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        held = regex.compile(kind)
        asked = [
            c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and held.match(c)
        ]
        # What the library knows joins the letter or number before it; else a split ends between them.
        ends = {end for _, (_, end) in library.pre_tokenize_str("".join(f"{base}{c}!" for c in asked))}
        odd += [ord(c) for n, c in enumerate(asked) if 3 * n + 1 in ends]
    odd.sort()
    ends = [a for a, b in zip(odd, [*odd[1:], -1], strict=True) if b != a + 1]
    starts = [b for a, b in zip([-2, *odd[:-1]], odd, strict=True) if b != a + 1]
    ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))
    return regex.compile(f"[{ranges}]" if ranges else r"(?!)")


def _latin(pattern: str) -> re.Pattern:
    """The pattern for texts of the first 256 code points, whose classes are listed: faster to match."""

    def ranges(kind: str) -> str:
        held = regex.compile(kind)
        return "".join(f"\\x{c:02x}" for c in range(256) if held.match(chr(c)))

    letters, numbers, spaces = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    listed = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for kind, class_ in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
        listed = listed.replace(kind, f"[{class_}]")
    listed = listed.replace(r"\S", f"[^{spaces}]")
    if "\\p" in listed:
        raise ValueError(f"classes of this pattern are not known here: {pattern}")
    return re.compile(listed)


def splitter(pattern: str) -> Callable[[str], Iterator[list[str]]]:
    """Function that gives the matches of ``pattern`` in a text, in order, in lists of bounded length."""
    latin, whole = _latin(pattern), regex.compile(pattern)

    def split(text: str) -> Iterator[list[str]]:
        plain, compiled = text, latin
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # Stand-ins for letters that the libraries don't know.
            plain, compiled = worker_held("unknown letters", _unknown_letters).sub(STAND_IN, text), whole
        if plain == text and len(text) <= CHUNK:
            yield compiled.findall(text)
            return
        found = compiled.finditer(plain)
        while spans := list(islice(found, CHUNK)):
            yield [text[slice(*m.span())] for m in spans]

    return split


def weight(text: str) -> int:
    """About the bytes that a pre-token and what it maps to take in a cache."""
    return 200 + 6 * len(text)


class Bounded(dict):
    """Cache of what pre-tokens map to: a fixed first tier, and misses up to about ``limit`` bytes.

    Misses are held in two generations. When the young one is full it becomes the old one, and what is
    asked for again moves on from there without being encoded anew. Results don't depend on its state.
    """

    def __init__(self, first: dict, limit: int):
        super().__init__(first)
        self.first, self.limit, self.old, self.held = first, limit, {}, 0

    def learn(self, lists: list[list[str]], encode: Callable[[list[str]], list]) -> None:
        """Makes sure that all pre-tokens of ``lists`` are held, encoding the misses in one call."""
        asked = set().union(*lists)
        missing = asked.difference(self)
        more = sum(map(weight, missing))
        if self.held + more > self.limit // 2:
            self.old = dict(self)
            self.clear()
            self.update(self.first)
            missing = asked.difference(self)
            self.held, more = 0, sum(map(weight, missing))
        self.held += more
        known = missing & self.old.keys()
        self.update((t, self.old[t]) for t in known)
        new = list(missing - known)
        if new:
            self.update(zip(new, encode(new), strict=True))
