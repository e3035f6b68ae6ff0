"""Periodic runs of words: suffix-tree extension queries from Lyndon roots.

A run is a stretch of words with smallest period q, at least ``exponent`` times as long, that no
neighbouring word extends. Every run has a Lyndon root for one of the two orders of the alphabet: the
longest Lyndon word that starts where the root does. So at each word there are two candidates (place
and period), and two extension queries, to the right in the document and to the left in its reversal,
tell how far a candidate's period holds. A query is the lowest common ancestor of two leaves of a
suffix tree, found in constant time in the tree's Euler tour.

Trees are built of the stretches that can hold a run at all: there every gram of some words is found
again at a distance of one period. This is a necessary condition, so no run is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.tables import table
from muster.llm.words import Words, mix
from muster.llm.workers import parts

MIN_WORDS = 24
EXPONENT = 3
RUN = "struct<start:long, length:long, period:long>"


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of positive numbers; 0 is added as its end.

    Children are held in one dict by (node, first symbol). A leaf's suffix is the order of its making.
    """

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        n, width = len(text), max(text) + 1
        start, end, link, children, leaves = [-1], [-1], [0], {}, []
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            inner = 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                place = node * width + text[edge]
                child = children.get(place)
                if child is None:
                    children[place] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if inner:
                        link[inner] = node
                    inner = node
                else:
                    size = end[child] - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    middle = start[child] + length
                    if text[middle] == symbol:
                        length += 1
                        if inner:
                            link[inner] = node
                        break
                    split = len(start)
                    start += (start[child], i)
                    end += (middle, n)
                    link += (0, 0)
                    start[child] = middle
                    children[place] = split
                    children[split * width + text[middle]] = child
                    children[split * width + symbol] = split + 1
                    leaves.append(split + 1)
                    if inner:
                        link[inner] = split
                    inner = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.size, nodes = n, len(start)
        places = np.fromiter(children.keys(), np.int64, len(children))
        to = np.fromiter(children.values(), np.int64, len(children))
        del children, link
        # Children of a node stand together, by their first symbol.
        order = np.argsort(places)
        self._child = to[order]
        parent = places[order] // width
        self._first = np.searchsorted(parent, np.arange(nodes + 1))
        self._parent = np.zeros(nodes, np.int64)
        self._parent[self._child] = parent
        self._length = np.array(end) - np.array(start)
        self._length[0] = 0
        self._suffix = np.full(nodes, -1, np.int64)
        self._suffix[leaves] = np.arange(n)

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour, reduced to its leaves: their suffixes in order, and the depth of the shallowest
        node between each and the one before, which is their lowest common ancestor.

        ``falling`` turns the order of the symbols around; the end comes before all others either way.
        """
        child, first, parent = self._child.tolist(), self._first.tolist(), self._parent.tolist()
        length, suffix = self._length.tolist(), self._suffix.tolist()
        depth = [0] * len(parent)
        order, low = [], []
        stack, turn, after_leaf = [0], 0, False
        while stack:
            node = stack.pop()
            above = depth[parent[node]]
            if after_leaf:
                turn, after_leaf = above, False
            if suffix[node] >= 0:
                order.append(suffix[node])
                low.append(turn)
                after_leaf = True
                continue
            depth[node] = above + length[node]
            below = child[first[node] : first[node + 1]]
            if not falling:
                below.reverse()
            elif suffix[below[0]] >= 0 and depth[node] + suffix[below[0]] == self.size - 1:
                below.append(below.pop(0))
            stack += below
        return np.array(order), np.array(low, np.int32)


class Extension:
    """Constant-time length of the longest common prefix of two suffixes."""

    def __init__(self, order: np.ndarray, low: np.ndarray):
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        # Least depth of 1, 2, 4, … neighbours.
        self.least = [low]
        size = 1
        while 2 * size <= len(low):
            row = self.least[-1]
            self.least.append(np.minimum(row[:-size], row[size:]))
            size *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.rank[a], self.rank[b]
        x, y = np.minimum(x, y) + 1, np.maximum(x, y)
        out = np.zeros(len(x), np.int64)
        level = np.frexp((y - x + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            row = self.least[k]
            out[at] = np.minimum(row[x[at]], row[y[at] - (1 << int(k)) + 1])
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of lower rank: where the longest Lyndon word of a place ends."""
    out = np.zeros(len(rank), np.int64)
    open_: list[int] = []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs_of(symbols: list[int], min_words: int, exponent: int) -> np.ndarray:
    """(start, length, period) of all runs of a sequence of positive numbers, by start, then period."""
    n = len(symbols)
    tree = SuffixTree(symbols)
    rising = tree.tour()
    falling = np.empty(n + 1, np.int64)
    falling[tree.tour(falling=True)[0]] = np.arange(n + 1)
    del tree
    right = Extension(*rising)
    ends = [_next_smaller(rank.tolist())[:n] for rank in (right.rank, falling)]
    i = np.concatenate([np.arange(n)] * 2)
    j = np.concatenate(ends)
    fits = exponent * (j - i) <= n
    i, j = i[fits], j[fits]
    end = j + right(i, j)
    del right, rising
    # What is left of a place is what is right of it in the reversal.
    left = Extension(*SuffixTree(symbols[::-1]).tour())
    start = i - left(n - i, n - j)
    found = np.stack([start, end - start, j - i], axis=1)
    found = found[found[:, 1] >= np.maximum(min_words, exponent * found[:, 2])]
    return np.unique(found, axis=0)


def stretches(words: Words, min_words: int, exponent: int) -> list[tuple[int, int, int]]:
    """(text, first word, word after the last) of all stretches that can hold a run.

    In a run of period q every gram of ``k`` words is found again q words before or after, if
    k <= length + 1 - 2 q for all runs that count; and q is at most the length of the stretch divided
    by ``exponent``. Grams without such a copy are taken out until none is left to take. Unequal grams
    of one hash only make a stretch longer.
    """
    k = min_words * (exponent - 2) // exponent + 1
    starts, text = words.windows(k)
    if not len(starts):
        return []
    grams = words.spans(starts, k)
    grams = mix(grams ^ mix(text.astype(np.uint64)))
    order = np.argsort(grams, kind="stable")
    near = np.full(len(starts), np.iinfo(np.int64).max // (exponent + 1))
    same = grams[order[1:]] == grams[order[:-1]]
    before, after = order[:-1][same], order[1:][same]
    gap = starts[after] - starts[before]
    near[before] = gap
    near[after] = np.minimum(near[after], gap)
    at = np.arange(len(starts))
    while True:
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.append(first, len(at)))
        length = np.repeat(sizes + k - 1, sizes)
        stays = (length >= min_words) & (exponent * near[at] <= length)
        if stays.all():
            begin = starts[at[first]]
            return list(zip(text[at[first]].tolist(), begin.tolist(), (begin + sizes + k - 1).tolist(), strict=True))
        at = at[stays]


def _analysed(texts: pa.Array, min_words: int, exponent: int) -> Iterator[dict]:
    found: dict[int, list[tuple[int, int]]] = {}
    words = Words(texts, lower=False)
    for text, first, last in stretches(words, min_words, exponent):
        base = int(words.first[text])
        found.setdefault(text, []).append((first - base, last - base))
    del words
    for text, value in enumerate(texts):
        tokens = (value.as_py() or "").encode().split()
        runs, gone = [], np.zeros(len(tokens) + 1, np.int64)
        for first, last in found.get(text, ()):
            names: dict[bytes, int] = {}
            symbols = [names.setdefault(w, len(names) + 1) for w in tokens[first:last]]
            for start, length, period in runs_of(symbols, min_words, exponent).tolist():
                runs.append({"start": first + start, "length": length, "period": period})
                gone[first + start + period] += 1
                gone[first + start + length] -= 1
        kept = tokens
        if runs:
            runs.sort(key=lambda r: (r["start"], r["period"]))
            kept = [tokens[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        yield {
            "n_words": len(tokens),
            "runs": runs,
            "strongest": max(
                runs,
                key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]),
                default=None,
            ),
            "collapsed": b" ".join(kept).decode(),
        }


def periodic_runs(
    documents: DataFrame, min_words: int = MIN_WORDS, exponent: int = EXPONENT, text: str = "text"
) -> DataFrame:
    """``document`` (the row as a struct) and ``periods``: ``n_words``, ``runs``, ``strongest``, ``collapsed``.

    Words are runs of characters other than ASCII white space, unchanged, numbered from 0. ``runs`` are
    (start, length, period) of every maximal stretch with smallest period q and a length of at least
    ``max(min_words, exponent * q)``, by start, then period. ``strongest`` is the one of greatest
    length / period (ties: smallest start, then period), null without a run. ``collapsed`` is the
    text without the words that some run holds after its first period; words are joined by one space.

    A row is analysed by itself, so nothing is shuffled and equal rows give equal results. Null or
    empty text: no words, no runs, empty text. Texts of any length are analysed whole: a worker holds
    one text, and a tree of one stretch that can hold a run takes about 400 bytes a word of it. Empty
    table: no rows. Extra columns stay inside ``document``, whatever their names.
    """
    if exponent < 2 or min_words < exponent:
        raise ValueError("a run holds its period twice, and as many words")

    @F.arrow_udf(f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")
    def analysed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        kinds = {"n_words": pa.int64(), "runs": pa.list_(run), "strongest": run, "collapsed": pa.string()}
        for batch in batches:
            rows = [r for part in parts(batch, 1 << 20) for r in _analysed(part, min_words, exponent)]
            yield pa.array(rows, pa.struct(list(kinds.items())))

    return documents.select(F.struct("*").alias("document"), analysed(F.col(text)).alias("periods"))


def _made_periodic(text: Column, checksum: Column) -> Column:
    """Texts of which every tenth repeats a part of itself from some word on, as its checksum says."""

    @F.arrow_udf("string")
    def made(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sums in batches:
            out = []
            for value, h in zip(texts.to_pylist(), sums.to_pylist(), strict=True):
                if value is not None and h is not None and h % 10 == 0 and (words := value.encode().split()):
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    value = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
                out.append(value)
            yield pa.array(out, pa.string())

    return made(text, checksum)


def _lines(runs: Column) -> Column:
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), ""
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all whole documents, of which every tenth is made to repeat itself."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    made = _made_periodic(F.col("text"), F.crc32(F.col("doc_id").cast("string")))
    best = F.col("periods.strongest")
    return periodic_runs(documents.select("doc_id", made.alias("text"))).select(
        "document.doc_id",
        F.size("periods.runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("1000 * periods.strongest.length div periods.strongest.period").alias("exponent_milli"),
        F.sha2(_lines(F.col("periods.runs")), 256).alias("runs_sha256"),
        F.sha2("periods.collapsed", 256).alias("collapsed_sha256"),
    )
