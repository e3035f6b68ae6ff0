"""Benchmark passages in documents: q-gram lemma filtering in diagonal bands, then banded alignment."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from muster.llm.tables import stored, table
from muster.llm.words import mix
from muster.llm.workers import parts, worker_held

Q = 10
# Items are looked for in segments of so many characters, one every few characters: a quote of
# SEGMENT + STRIDE - 1 characters holds a whole segment, wherever it begins.
SEGMENT, STRIDE = 64, 12
# Edits that a segment may have, in percent of its characters.
EDIT_PERCENT = 8
# Characters of an item that are found wherever they are quoted without an edit.
QUOTE = 50
# Shorter items are ordinary phrases, and are looked for only as whole lines or sentences.
MIN_CHARS = 24
# Where lines and sentences end.
BREAK = regex.compile(r"[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]|[.!?…]+(?!\w)|[。！？]")
# Characters of items in one broadcast; a larger benchmark is taken in blocks.
BLOCK_CHARS = 8_000_000
BITS = 22
ALIGNED = 2048
BASE = 0x9E3779B97F4A7C15


def normalise(text: str) -> str:
    """Lower-cased runs of letters, digits and underscores, one space between them."""
    return " ".join(regex.findall(r"\w+", text.lower()))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` characters from each place."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    # Runs of 1, 2, 4, ... characters are put together as the bits of q say.
    run, size = codes.astype(np.uint64), 1
    out, done = np.zeros(len(codes), np.uint64), 0
    while True:
        if q & size:
            shift = np.uint64(pow(BASE, size, 1 << 64))
            out = out[: len(run) - done] * shift + run[done : done + len(out)]
            done += size
        size *= 2
        if size > q:
            return mix(out[: len(codes) - q + 1])
        shift = np.uint64(pow(BASE, size // 2, 1 << 64))
        run = run[: len(run) - size // 2] * shift + run[size // 2 :]


def budget(length: int) -> int:
    """Edits allowed in a segment: the share of its length, if the lemma then still filters."""
    return max(0, min(length * EDIT_PERCENT // 100, (length - Q) // Q))


class Benchmark:
    """The segments of normalised items, and the places of their q-grams."""

    def __init__(self, texts: list[str]):
        items = [code_points(normalise(t)) for t in texts]
        segments, grams, owners, places = [], [], [], []
        self.first: list[int] = []
        # Items too short for segments, by what they read.
        self.short: dict[str, list[int]] = {}
        for i, codes in enumerate(items):
            self.first.append(len(segments))
            if len(codes) < MIN_CHARS:
                if len(codes):
                    self.short.setdefault(normalise(texts[i]), []).append(i)
                continue
            size = min(SEGMENT, len(codes))
            starts = sorted({*range(0, len(codes) - size + 1, STRIDE), len(codes) - size})
            segments += [(i, s, size) for s in starts]
            found = qgrams(codes, Q)
            grams.append(found)
            owners.append(np.full(len(found), i))
            places.append(np.arange(len(found)))
        self.first = np.array([*self.first, len(segments)])
        self.items = items
        self.item, self.start, self.size = np.array(segments, np.int64).reshape(-1, 3).T
        self.codes = np.zeros((len(segments), SEGMENT), np.uint32)
        for row, (i, s, n) in enumerate(segments):
            self.codes[row, :n] = items[i][s : s + n]
        self.edits = np.array([budget(n) for n in self.size], np.int64)
        self.needed = self.size - Q + 1 - Q * self.edits
        # A band holds any run of diagonals that the edits of any segment can reach.
        self.width = 2 * int(self.edits.max(initial=0)) + 1
        least = np.full(len(items), np.iinfo(np.int64).max)
        np.minimum.at(least, self.item, self.needed)
        self.least = least
        grams = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.owner = np.concatenate([*owners, np.zeros(0, np.int64)])[order]
        self.place = np.concatenate([*places, np.zeros(0, np.int64)])[order]
        self.grams, begin = np.unique(grams[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[self._short(self.grams)] = True

    @staticmethod
    def _short(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - BITS)).astype(np.int64)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of all shared q-grams."""
        grams = qgrams(codes, Q)
        at = np.flatnonzero(self.maybe[self._short(grams)])
        known = np.searchsorted(self.grams, grams[at])
        known = np.minimum(known, len(self.grams) - 1)
        same = self.grams[known] == grams[at] if len(self.grams) else np.zeros(0, bool)
        at, known = at[same], known[same]
        count = self.begin[known + 1] - self.begin[known]
        x = np.repeat(at, count)
        entry = np.repeat(self.begin[known] - (np.cumsum(count) - count), count) + np.arange(len(x))
        return x, self.owner[entry], self.place[entry]

    def alone(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, place) of the short items that are one or more whole lines or sentences of a text."""
        pieces = [p for p in map(normalise, BREAK.split(text)) if p]
        begin = 0
        for n, piece in enumerate(pieces):
            run, after = piece, n + 1
            while len(run) < MIN_CHARS:
                yield from ((i, begin) for i in self.short.get(run, ()))
                if after == len(pieces):
                    break
                run, after = f"{run} {pieces[after]}", after + 1
            begin += len(piece) + 1

    def quotes(self, hits: tuple[np.ndarray, ...], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, place) of the runs of QUOTE or more characters that a text shares with an item."""
        x, item, y = hits
        needed = QUOTE - Q + 1
        # Most places are in stretches of known q-grams that are too short for any run.
        begin = np.flatnonzero(np.diff(x, prepend=-2) > 1)
        last = np.append(begin[1:], len(x))[: len(begin)] - 1
        kept = np.repeat(x[last] - x[begin] + 1 >= needed, last - begin + 1)
        x, item, y = x[kept], item[kept], y[kept]
        order = np.lexsort((x, x - y, item))
        x, item, y = x[order], item[order], y[order]
        # A run's q-grams are neighbours in the text, on one diagonal of one item.
        joined = (np.diff(x) == 1) & (np.diff(y) == 1) & (np.diff(item) == 0)
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), ~joined]))
        begin = begin[np.diff(begin, append=len(x)) >= needed]
        text = np.searchsorted(ends, x[begin], "right")
        return text, item[begin], x[begin] - np.concatenate([[0], ends])[text]

    def regions(
        self, hits: tuple[np.ndarray, ...], codes: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, segment, first diagonal) of the bands with as many shared q-grams as the lemma asks.

        ``codes`` are texts one after the other, which end at ``ends``, and ``hits`` theirs. A segment with at most e edits
        shares at least size - Q + 1 - Q * e q-grams with the text, all of them on diagonals within e of
        where it begins. Bands are two widths wide and start at each width, so one holds them all.
        """
        x, item, y = hits
        text = np.searchsorted(ends, x, "right")
        # No place in an item is further back than the longest one's last; one width more is for lane - 1.
        shift = (max(map(len, self.items), default=0) // self.width + 2) * self.width
        lane = (x - y + shift) // self.width
        lanes = int(lane.max(initial=0)) + 2

        def busy(owner: np.ndarray, owners: int, needed: np.ndarray, band: np.ndarray, of: np.ndarray):
            if lanes * owners * (len(ends) + 1) >= 1 << 62:
                raise ValueError("a block of texts is too large")
            key = (of * owners + owner) * lanes + band
            unique, back, count = np.unique(key, return_inverse=True, return_counts=True)
            enough = count >= needed[(unique // lanes) % owners]
            return unique[enough], enough[back]

        # First by item, for the segment that needs least; then by segment.
        bands = np.concatenate([lane, lane - 1])
        both = np.tile(np.arange(len(x)), 2)
        _, kept = busy(item[both], max(1, len(self.items)), self.least, bands, text[both])
        both, bands = both[kept], bands[kept]
        own = item[both]
        many = self.first[own + 1] - self.first[own]
        row = np.repeat(np.arange(len(both)), many)
        segment = np.repeat(self.first[own] - (np.cumsum(many) - many), many) + np.arange(len(row))
        inside = y[both[row]] - self.start[segment]
        fits = (inside >= 0) & (inside <= self.size[segment] - Q)
        row, segment = row[fits], segment[fits]
        owners = max(1, len(self.item))
        found, _ = busy(segment, owners, self.needed, bands[row], text[both[row]])
        diagonal = (found % lanes) * self.width - shift
        return found // lanes // owners, (found // lanes) % owners, diagonal

    def aligned(
        self, hits: tuple[np.ndarray, ...], codes: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, segment, edits, place) of the regions whose best alignment keeps to the budget."""
        text, segment, diagonal = self.regions(hits, codes, ends)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        slack = int(self.edits.max(initial=0))
        band = 2 * self.width + 2 * slack
        offsets = np.arange(band)
        edits, place = np.empty(len(text), np.int64), np.empty(len(text), np.int64)
        for at in range(0, len(text), ALIGNED):
            rows = slice(at, at + ALIGNED)
            seg, low = segment[rows], diagonal[rows] - slack + self.start[segment[rows]]
            lo, hi = begins[text[rows]][:, None], ends[text[rows]][:, None]
            cost = np.zeros((len(seg), band), np.int64)
            for i in range(int(self.size[seg].max(initial=0))):
                live = i < self.size[seg]
                want = self.codes[seg, i]
                where = low[:, None] + i + offsets
                valid = (where >= lo) & (where < hi)
                have = np.where(valid, codes[np.clip(where, 0, max(len(codes) - 1, 0))], 0)
                step = cost + (have != want[:, None])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                step = np.minimum.accumulate(step - offsets, axis=1) + offsets
                cost = np.where(live[:, None], step, cost)
            edits[rows] = cost.min(axis=1)
            place[rows] = np.maximum(low + cost.argmin(axis=1) - begins[text[rows]], 0)
        good = edits <= self.edits[segment]
        return text[good], segment[good], edits[good], place[good]


def _blocks(benchmark: DataFrame, text: str, limit: int) -> list[DataFrame]:
    """The items in blocks of about ``limit`` characters."""
    total = benchmark.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    count = -(-total // limit) or 1
    if count == 1:
        return [benchmark]
    block = F.pmod(F.xxhash64(*benchmark.columns), F.lit(count))
    return [benchmark.filter(block == i) for i in range(count)]


def with_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``document`` (the row as a struct) and ``matches``: items found in it.

    Texts are compared as lower-cased words with one space between them. An item is looked for in
    segments of 64 characters, one every 12 (a shorter item is one segment), each with up to 8 %
    of its characters edited: so quotes of 75 characters are found at any place, if 64 of them keep to that. A match counts its ``segments``, and has the ``edits`` and the normalised
    ``place`` of its best one. Besides, 50 or more characters of an item are found wherever they are
    quoted without an edit; where such a quote holds no segment, the match has 0 ``segments``, 0
    ``edits`` and the place where the first quote begins.

    Documents are not shuffled. The items are broadcast in blocks of bounded size, one after the other: the
    driver and the workers hold one block. A benchmark of one block is one pass over the documents; each
    further block reads them again, with the matches so far, from a stored table. Very long texts are
    looked through whole.

    An item of fewer than 24 normalised characters is found where it is, without edits, a whole text, line
    or sentence, or several in a row; it counts as one segment.

    Null or empty document: no match. Null item, or one without words: not looked for. Repeated items: each
    is found. Empty tables: no rows, or no matches. Extra columns stay inside ``document``, whatever their
    names.
    """
    kind = benchmark.schema[item].dataType
    context = documents.sparkSession.sparkContext
    schema = f"array<struct<item: {kind.simpleString()}, segments: long, edits: int, place: long>>"
    fields = [("item", to_arrow_type(kind)), ("segments", pa.int64()), ("edits", pa.int32()), ("place", pa.int64())]

    def finder(block: DataFrame):
        rows = block.select(F.col(item).alias("i"), F.coalesce(item_text, F.lit("")).alias("t")).collect()
        sent = context.broadcast((uuid.uuid4().hex, [r["i"] for r in rows], [r["t"] for r in rows]))

        @F.arrow_udf(schema)
        def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            number, names, texts = sent.value
            held = worker_held("benchmark", dict)
            if number not in held:
                held.clear()
                held[number] = Benchmark(texts)
            for batch in batches:
                yield pa.concat_arrays([_found(p, held[number], names, fields) for p in parts(batch, 1 << 20)])

        return matches, sent

    found = documents.select(
        F.struct("*").alias("document"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.array().cast(schema).alias("matches"),
    )
    blocks = _blocks(benchmark, item_text, block_chars)
    for block in blocks:
        matches, sent = finder(block)
        new = matches("_text")
        found = found.withColumn("matches", new if block is blocks[0] else F.concat("matches", new))
        if block is not blocks[-1]:
            found = stored(found, "decontaminated")
            sent.destroy()
    return found.select("document", "matches")


def _found(texts: pa.Array, known: Benchmark, names: list, fields: list) -> pa.Array:
    given = texts.to_pylist()
    plain = [normalise(t) for t in given]
    codes = code_points("\0".join([*plain, ""]))
    ends = np.cumsum([len(p) + 1 for p in plain]) if plain else np.zeros(0, np.int64)
    hits = known.hits(codes)
    text, segment, edits, place = known.aligned(hits, codes, ends)
    best: list[dict] = [{} for _ in plain]
    seen = set()
    for t, s, e, p in zip(text.tolist(), segment.tolist(), edits.tolist(), place.tolist(), strict=True):
        i = int(known.item[s])
        old = best[t].get(i, (0, e, p))
        best[t][i] = (old[0] + ((t, s) not in seen), *min(old[1:], (e, p)))
        seen.add((t, s))
    for t, i, p in sorted(zip(*(c.tolist() for c in known.quotes(hits, ends)), strict=True)):
        best[t].setdefault(i, (0, 0, p))
    for t, value in enumerate(given if known.short else []):
        for i, p in known.alone(value):
            best[t].setdefault(i, (1, 0, p))
    rows = [[(names[i], *best_of) for i, best_of in sorted(b.items())] for b in best]
    flat = [r for row in rows for r in row]
    columns = list(zip(*flat, strict=True)) or [[] for _ in fields]
    struct = pa.StructArray.from_arrays(
        [pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), struct)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = with_matches(documents, table(spark, folder, "benchmark"))
    rows = found.select("document.doc_id", F.explode("matches").alias("m"))
    return rows.select("doc_id", F.col("m.item").alias("item_id"), "m.segments", "m.edits", "m.place")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the documents that hold no benchmark item, unchanged.

    Null and empty texts hold none. Repeated rows are judged alike. Empty table: no rows. Extra columns
    stay as they are, whatever their names.
    """
    found = with_matches(docs, table(spark, folder, "benchmark"))
    return found.filter(F.size("matches") == 0).select("document.*")
