"""Repeated passages of words: a De Bruijn graph of token k-mers, compacted around minimizers.

The edges of the graph are the windows of ``WINDOW`` words (token k-mers), the nodes what two successive
windows share. A window's anchor is the first of its ``ANCHOR``-word grams with the least hash, so equal
windows have equal anchors at equal places. The windows of one text around one anchor are a path of the
graph; it leaves the text as one row, with a digest of all its words.

* An anchor that occurs once has no repeated window: it goes.
* An anchor with one digest in the whole corpus is the middle of a nonbranching path: all its windows
  repeat together, and the first occurrence is the source of all others.
* At a branching anchor the equal digests are compacted to their first occurrence. Only that one is
  opened into its windows, which meet those of the other digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.tables import stored, table
from muster.llm.words import OTHER_BASE, Words, mix
from muster.llm.workers import parts

WINDOW = 20
ANCHOR = 8
# An occurrence of an anchor is one number: its word, how far the path reaches back, how many windows.
FIELD = 1024


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value in each run of ``width`` values."""
    at = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


class Paths:
    """The paths of a batch of texts: one per anchor occurrence."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        self.words = Words(texts, lower=False)
        starts, text = self.words.windows(window)
        if not len(starts):
            self.text = self.place = self.back = self.count = np.zeros(0, np.int64)
            self.anchor = self.digest = np.zeros(0, np.uint64)
            return
        grams = self.words.spans(np.arange(len(self.words.hash) - anchor + 1), anchor)
        middle = _least(grams, window - anchor + 1)[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (middle[1:] != middle[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:], len(starts)) - 1
        self.text, word = text[begin], middle[begin]
        self.place = word - self.words.first[self.text]
        self.back = word - starts[begin]
        self.count = starts[last] - starts[begin] + 1
        self.anchor = grams[word]
        shape = (self.back * FIELD + self.count).astype(np.uint64)
        content = self.words.spans(starts[begin], self.count + window - 1, OTHER_BASE)
        self.digest = mix(content ^ mix(shape))


def _identified(documents: DataFrame, text: str, key: str) -> DataFrame:
    """(document, doc, text): a row as a struct, and what tells it apart: its key and a digest of its text."""
    value = F.coalesce(F.col(text), F.lit(""))
    doc = F.struct(F.col(key).alias("key"), F.xxhash64(value).alias("text"))
    return documents.select(F.struct("*").alias("document"), doc.alias("doc"), value.alias("text"))


def _occurrences(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, digest, doc, at) of every path."""
    schema = T.StructType(
        [
            T.StructField("anchor", T.LongType()),
            T.StructField("digest", T.LongType()),
            T.StructField("doc", rows.schema["doc"].dataType),
            T.StructField("at", T.LongType()),
        ]
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in parts(batch.column(1), 1 << 20):
                p = Paths(part, window, anchor)
                ids = batch.column(0).slice(done, len(part)).take(pa.array(p.text))
                done += len(part)
                at = (p.place * FIELD + p.back) * FIELD + p.count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.anchor.view(np.int64)), pa.array(p.digest.view(np.int64)), ids, pa.array(at)],
                    names=schema.names,
                )

    return rows.select("doc", "text").mapInArrow(walk, schema)


def _place(at: Column) -> tuple[Column, Column]:
    """First word of a path, and the number of its words less those of a window."""
    back, count = F.shiftright(at, 10) % FIELD, at % FIELD
    return (F.shiftright(at, 20) - back).cast("int"), (count - 1).cast("int")


def _path_spans(paths: DataFrame, window: int) -> DataFrame:
    """Spans of the paths that have a ``source`` (doc, at) elsewhere."""
    start, more = _place(F.col("at"))
    begin = _place(F.col("source.at"))[0]
    return paths.select(
        "doc", start.alias("start"), (start + more + window).alias("end"),
        F.col("source.doc").alias("source"), begin.alias("begin"),
    )


def _opened(rows: DataFrame, heads: DataFrame, window: int) -> DataFrame:
    """(anchor, gram, doc, start) of every window of the paths in ``heads``, read from the texts."""

    @F.arrow_udf("array<struct<anchor:long, gram:long, start:int>>")
    def windows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            found, done = [], 0
            for part in parts(texts, 1 << 20):
                words = Words(part, lower=False)
                paths = lists.slice(done, len(part))
                done += len(part)
                rows = paths.flatten()
                of = np.repeat(np.arange(len(part)), paths.value_lengths().to_numpy(zero_copy_only=False))
                at = rows.field(1).to_numpy(zero_copy_only=False)
                count = at % FIELD
                begin = (at >> 20) - (at >> 10) % FIELD
                path = np.repeat(np.arange(len(at)), count)
                start = begin[path] + np.arange(len(path)) - np.repeat(np.cumsum(count) - count, count)
                grams = words.spans(words.first[of[path]] + start, window, OTHER_BASE)
                sizes = np.bincount(of[path], minlength=len(part))
                struct = pa.StructArray.from_arrays(
                    [
                        rows.field(0).take(pa.array(path)),
                        pa.array(grams.view(np.int64)),
                        pa.array(start.astype(np.int32)),
                    ],
                    names=["anchor", "gram", "start"],
                )
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                found.append(pa.ListArray.from_arrays(pa.array(offsets), struct))
            yield pa.concat_arrays(found)

    listed = heads.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at")).alias("paths"))
    met = rows.select("doc", "text").join(listed, "doc")
    opened = met.select("doc", F.explode(windows("text", "paths")).alias("w"))
    return opened.select("w.anchor", "w.gram", "doc", "w.start")


def repeated_spans(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc, start, end, source, begin): spans of words covered by windows that start earlier elsewhere.

    ``rows`` have (doc, text). Earlier is a smaller document, or the same document and a smaller word;
    ``begin`` is the word of ``source`` where the same words start. Every such window is in a span, and
    every span is made of such windows; spans may overlap.

    Anchors are counted with partial sums, occurrences then join the anchors that repeat, so an anchor
    that a third of all texts hold meets in no task that cannot be split. Windows are told apart by
    their anchor and their own hash (for a path its digest), made of separate halves of the words' digests.
    """
    walked = stored(_occurrences(rows, window, anchor), "path-occurrences")
    repeated = (
        walked.groupBy("anchor")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("digest").alias("low"),
            F.max("digest").alias("high"),
            F.min(F.struct("doc", "at")).alias("source"),
        )
        .filter("n > 1")
        .select("anchor", "source", (F.col("low") == F.col("high")).alias("straight"))
    )
    # Stored tables on both sides of a join: adaptive execution can split a hot anchor, which it could
    # not while one side comes straight from the aggregate.
    repeated = stored(repeated, "path-anchors")
    here = F.struct("doc", "at")
    met = walked.join(repeated, "anchor").filter(~(F.col("straight") & (here == F.col("source"))))
    source = F.when(F.col("straight"), F.col("source")).alias("source")
    met = stored(met.select("anchor", "digest", "doc", "at", source), "paths")
    straight = _path_spans(met.filter("source is not null"), window)

    branching = met.filter("source is null").drop("source")
    heads = branching.groupBy("anchor", "digest").agg(F.min(here).alias("source"))
    heads = stored(heads, "path-heads")
    copies = branching.join(heads, ["anchor", "digest"]).filter(here != F.col("source"))
    opened = stored(_opened(rows, heads.select("anchor", "source.doc", "source.at"), window), "path-windows")
    there = F.struct("doc", "start")
    sources = (
        opened.groupBy("anchor", "gram").agg(F.min(there).alias("source"), F.max(there).alias("other"))
    ).filter(F.col("source") != F.col("other"))
    sources = stored(sources, "path-sources").select("anchor", "gram", "source")
    later = opened.join(sources, ["anchor", "gram"]).filter(there != F.col("source"))
    single = later.select(
        "doc", "start", (F.col("start") + window).alias("end"),
        F.col("source.doc").alias("source"), F.col("source.start").alias("begin"),
    )
    return straight.unionByName(_path_spans(copies, window)).unionByName(single)


def _joined(starts: np.ndarray, ends: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping spans of one group as one: starts, ends, and a span of each."""
    order = np.lexsort((starts, groups))
    starts, ends, groups = starts[order], ends[order], groups[order]
    # A group's ends lie above all of the groups before.
    room = int(ends.max()) + 1
    reach = np.maximum.accumulate(ends + groups * room) - groups * room
    new = np.ones(len(starts), bool)
    new[1:] = (groups[1:] != groups[:-1]) | (starts[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return starts[first], reach[np.append(first[1:], len(starts)) - 1], order[first]


def _long_spans(spans: DataFrame) -> DataFrame:
    """Spans that continue each other in a document and in its source, as one each."""
    source = spans.schema["source"].dataType
    key, text = (source[f].dataType.simpleString() for f in ("key", "text"))
    out = f"array<struct<start:int, end:int, source:struct<key:{key}, text:{text}>, begin:int>>"

    @F.arrow_udf(out)
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            rows, sizes = [], [0]
            for found in lists:
                spans = found.values
                start, end, origin, begin = (spans.field(f) for f in ("start", "end", "source", "begin"))
                s, e, b = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (start, end, begin))
                names: dict[tuple, int] = {}
                shift = (s - b).tolist()
                ids = zip(origin.field("key").to_pylist(), origin.field("text").to_pylist(), shift, strict=True)
                groups = np.array([names.setdefault(x, len(names)) for x in ids], np.int64)
                s, e, one = _joined(s, e, groups)
                columns = (
                    pa.array(s, pa.int32()), pa.array(e, pa.int32()), origin.take(pa.array(one)),
                    pa.array(s - np.array(shift)[one], pa.int32()),
                )
                rows.append(pa.StructArray.from_arrays(columns, names=["start", "end", "source", "begin"]))
                sizes.append(len(s))
            if rows:
                offsets = pa.array(np.cumsum(sizes).astype(np.int32))
                yield pa.ListArray.from_arrays(offsets, pa.concat_arrays(rows))
            else:
                yield lists

    listed = spans.groupBy("doc").agg(F.collect_set(F.struct("start", "end", "source", "begin")).alias("spans"))
    return listed.select("doc", F.explode(joined("spans")).alias("s")).select("doc", "s.*")


def span_digest(words: list[bytes], start: int, end: int) -> bytes | None:
    """Digest of some words as they are; null if the text has not so many."""
    return blake2b(b" ".join(words[start:end]), digest_size=16).digest() if end <= len(words) else None


def _source_digests(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(source, begin, length, digest) of the words at each span's source, read from its text."""

    @F.arrow_udf("array<struct<begin:int, length:int, digest:binary>>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("begin", pa.int32()), ("length", pa.int32()), ("digest", pa.binary())])
        for texts, lists in batches:
            out = []
            for text, wanted in zip(texts, lists.to_pylist(), strict=True):
                words = text.as_py().encode().split()
                for w in wanted:
                    w["digest"] = span_digest(words, w["begin"], w["begin"] + w["length"])
                out.append(wanted)
            yield pa.array(out, pa.list_(kind))

    length = (F.col("end") - F.col("start")).alias("length")
    wanted = spans.select("source", "begin", length).distinct()
    listed = wanted.groupBy("source").agg(F.collect_list(F.struct("begin", "length")).alias("wanted"))
    met = rows.select(F.col("doc").alias("source"), "text").join(listed, "source")
    found = met.select("source", F.explode(read("text", "wanted")).alias("d")).select("source", "d.*")
    return found.dropDuplicates(["source", "begin", "length"])


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``document`` (the row as a struct) and ``words``: ``n_words``, ``n_removed``, the ``kept`` text.

    Words are runs of characters other than ASCII white space, unchanged. Each word covered by a window
    of ``window`` words that starts earlier too is removed; windows are judged on the input. Kept words
    are joined by one space.

    Spans that continue each other are joined, and each long one is compared with the words at its
    source's coordinates before it goes: both texts are read, and the 128-bit digests of their words must be
    equal. A document's list of spans is at most as long as the document; texts are joined with it by
    key and a digest of the text.

    Null, empty or short text: nothing is removed. Very long texts are read whole, by one worker each. Rows
    without key come before all others. Rows of one key with different texts are documents of their own,
    in the order of a digest of the text, and so are rows without key. Rows equal in key and text are the
    same document: none starts earlier than its copy, and they are cut alike. Empty table: no rows. Extra
    columns stay inside ``document``, whatever their names.
    """
    if not 0 < anchor < window < FIELD:
        raise ValueError("an anchor is shorter than a window")
    rows = _identified(documents, text, key)
    spans = stored(_long_spans(repeated_spans(rows, window, anchor)), "long-spans")
    digests = stored(_source_digests(rows, spans), "source-digests")
    place = (F.col("end") - F.col("start")).alias("length")
    checked = spans.select("doc", "start", "source", "begin", place).join(digests, ["source", "begin", "length"])
    listed = checked.groupBy("doc").agg(F.collect_set(F.struct("start", "length", "digest")).alias("spans"))

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for value, found in zip(texts, lists.to_pylist(), strict=True):
                words = value.as_py().encode().split()
                kept = words
                if found:
                    change = np.zeros(len(words) + 1, np.int64)
                    for span in found:
                        start, end = span["start"], span["start"] + span["length"]
                        if (digest := span_digest(words, start, end)) and digest == span["digest"]:
                            change[start] += 1
                            change[end] -= 1
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["n_words", "n_removed", "kept"],
            )

    joined = rows.join(listed, "doc", "left")
    return joined.select("document", cut("text", "spans").alias("words"))


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document less the words of repeated windows of 20."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(documents).select(
        "document.doc_id", "words.n_words", "words.n_removed", F.sha2("words.kept", 256).alias("kept_sha256")
    )
