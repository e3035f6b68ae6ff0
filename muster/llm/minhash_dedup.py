"""Near duplicates by circulant MinHash, verified on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.tables import stored, table
from muster.llm.words import Words, mix
from muster.llm.workers import parts

WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 5
SHIFT_BLOCK = 1 << 18
# Shingles and sets in a block that is compared with another block in one step, and shingles of them at once.
BLOCK_SHINGLES, BLOCK_ROWS = 100_000, 2000
COLUMNS = 4096
# Where the keys begin that the stage gives to rows whose id does not tell them apart.
OWN = 1 << 62


def _permute(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers: shifts and odd factors are bijective."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(first)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(second)
    return x ^ (x >> np.uint32(16))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set of 64-bit shingles, modulo 2**32.

    The first permutation scatters the shingles; coordinate k is the minimum of the second one, shifted
    circularly by k, over them.
    """
    scattered = _permute(shingles.astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    step = max(1, SHIFT_BLOCK // coordinates)
    for at in range(0, len(scattered), step):
        moved = _permute(scattered[None, at : at + step] + shifts, 0x85EBCA6B, 0xC2B2AE35)
        np.minimum(least, moved.min(axis=1), out=least)
    return least


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of the signature."""
    grid = signature(shingles, bands * rows).reshape(bands, rows).astype(np.uint64)
    key = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for row in range(rows):
        key = mix(key ^ grid[:, row])
    return key


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased.

    A text of fewer words is one shingle; one without words has none.
    """
    found = Words(texts, lower=True)
    counts, first = found.counts, found.first
    starts, text = found.windows(words)
    hashes = found.spans(starts, words)
    ends = np.searchsorted(text, np.arange(len(counts) + 1))
    for i, n in enumerate(counts):
        if n >= words:
            yield np.unique(hashes[ends[i] : ends[i + 1]])
        elif n:
            yield found.spans(first[i : i + 1], int(n))
        else:
            yield np.zeros(0, np.uint64)


def _profiles(documents: DataFrame, words: int, bands: int, rows: int, text: str, key: str) -> DataFrame:
    """(doc, n, s1, s2, bands) of every row: set size, 128-bit digest of the set, band keys."""
    schema = T.StructType(
        [
            T.StructField("doc", documents.schema[key].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("s1", T.LongType()),
            T.StructField("s2", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, digests, keys = 0, [], [], []
            for part in parts(batch.column(1), 1 << 20):
                for shingles in shingle_sets(part, words):
                    sizes.append(len(shingles))
                    digests.append(
                        (
                            mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64),
                            mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64),
                        )
                    )
                    keys.append(band_keys(shingles, bands, rows) if len(shingles) else np.zeros(0, np.uint64))
                at += len(part)
            first, second = np.array(digests, np.uint64).reshape(-1, 2).T.copy().view(np.int64)
            lengths = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(first),
                pa.array(second),
                pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "s1", "s2", "bands"])

    return documents.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(profile, schema)


def _sets(documents: DataFrame, ids: DataFrame, words: int, text: str, key: str) -> DataFrame:
    """(doc, shingles) of the documents in ``ids``."""

    @F.arrow_udf("array<long>")
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [s for part in parts(batch, 1 << 20) for s in shingle_sets(part, words)]
            lengths = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))

    chosen = documents.select(F.col(key).alias("doc"), F.col(text).alias("text")).join(ids, "doc", "left_semi")
    return chosen.select("doc", shingles("text").alias("shingles"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select(
        "a", "b", (F.size("x") + F.size("y")).alias("both"), F.size(F.array_intersect("x", "y")).alias("common")
    )
    return met.filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(doc, component): the smallest document that each end of an edge reaches.

    Minimum labels travel along the edges and are shortened through the label's own label, so chains
    halve; every round is written to the shared folder. The loop ends when a round changes nothing.
    """
    both = stored(
        edges.select(F.col("a").alias("doc"), F.col("b").alias("other"))
        .union(edges.select(F.col("b"), F.col("a")))
        .distinct(),
        f"{purpose}-edges",
    )
    labels = stored(
        both.groupBy("doc").agg(F.min("other").alias("least")).select("doc", F.least("doc", "least").alias("component")),
        purpose,
    )
    while True:
        near = both.join(labels.withColumnRenamed("doc", "other"), "other")
        least = near.groupBy("doc").agg(F.min("component").alias("near"))
        moved = labels.join(least, "doc").select(
            "doc", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        moved = stored(moved, purpose)
        above = moved.select(F.col("doc").alias("component"), F.col("component").alias("above"))
        new = moved.join(above, "component").select("doc", "old", F.col("above").alias("component"))
        new = stored(new, purpose)
        if new.filter("component <> old").isEmpty():
            return new.select("doc", "component")
        labels = new.select("doc", "component")


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``x`` with each of ``y``."""
    tokens = [np.concatenate(z) for z in (x, y)]
    owners = [np.repeat(np.arange(len(z)), [len(s) for s in z]) for z in (x, y)]
    shared = np.intersect1d(*tokens)
    counts = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        some = shared[at : at + COLUMNS]
        grids = []
        for t, owner, z in zip(tokens, owners, (x, y), strict=True):
            column = np.minimum(np.searchsorted(some, t), len(some) - 1)
            held = some[column] == t
            grid = np.zeros((len(z), len(some)), np.float32)
            grid[owner[held], column[held]] = 1
            grids.append(grid)
        counts += grids[0] @ grids[1].T
    return counts.astype(np.int64)


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that join what all links of a grid join, and no more than they need."""
    sides = near, np.ascontiguousarray(near.T)
    seen = [np.zeros(n, bool) for n in near.shape]
    found = []
    for start in np.flatnonzero(near.any(axis=1)):
        if seen[0][start]:
            continue
        seen[0][start] = True
        todo = [(0, start)]
        while todo:
            side, at = todo.pop()
            new = np.flatnonzero(sides[side][at] & ~seen[1 - side])
            seen[1 - side][new] = True
            ends = np.full(len(new), at), new
            found.append(ends if side == 0 else ends[::-1])
            todo += [(1 - side, k) for k in new.tolist()]
    return tuple(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))


def _apart(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between members of one group that no component joins, found block by block.

    ``groups`` has (centre, doc, n, component). The members in the centre's own component are linked
    already; the others are compared with them and with each other. Blocks are dealt by hash, have about
    ``BLOCK_SHINGLES`` shingles or ``BLOCK_ROWS`` sets at most, and only pairs of blocks are joined, so a group
    of any size is spread over many tasks. Of a pair of blocks only a spanning forest of its links
    leaves the task: fewer rows than the two blocks have members, not one per pair of members.
    """
    own = F.max(F.when(F.col("doc") == F.col("centre"), F.col("component")))
    centres = groups.groupBy("centre").agg(
        own.alias("own"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = stored(centres.filter("low <> high").select("centre", "own"), "minhash-mixed")
    placed = groups.join(mixed, "centre").withColumn("other", F.col("component") != F.col("own"))
    count = F.greatest(
        F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS))
    ).cast("int")
    sizes = stored(placed.groupBy("centre", "other").agg(count.alias("blocks")), "minhash-sizes")
    dealt = placed.join(sizes, ["centre", "other"]).withColumn(
        "block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    )
    member = F.struct("doc", "component", "shingles")
    blocks = (
        dealt.join(sets, "doc").groupBy("centre", "other", "block").agg(F.collect_list(member).alias("members"))
    )
    blocks = stored(blocks, "minhash-blocks")
    some = blocks.filter("other").select("centre", F.col("block").alias("one"))
    every = blocks.select("centre", "other", F.col("block").alias("two"))
    met = some.join(every, "centre").filter(~F.col("other") | (F.col("one") <= F.col("two")))
    left = blocks.filter("other").select("centre", F.col("block").alias("one"), F.col("members").alias("x"))
    right = blocks.select("centre", "other", F.col("block").alias("two"), F.col("members").alias("y"))

    @F.arrow_udf("array<struct<a:long, b:long>>")
    def links(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pairs in batches:
            rows = []
            for both in zip(*pairs, strict=True):
                sides = []
                for side in both:
                    members = side.values
                    sets = members.field("shingles")
                    flat = sets.flatten().to_numpy(zero_copy_only=False)
                    at = np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))])
                    sides.append(
                        (
                            [flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True)],
                            members.field("component").to_numpy(zero_copy_only=False),
                            np.diff(at),
                            members.field("doc").to_numpy(zero_copy_only=False),
                        )
                    )
                (x, cx, nx, dx), (y, cy, ny, dy) = sides
                common = _common(x, y)
                near = 100 * common >= percent * (nx[:, None] + ny[None, :] - common)
                i, j = _forest(near & (cx[:, None] != cy[None, :]))
                rows.append([{"a": a, "b": b} for a, b in zip(dx[i].tolist(), dy[j].tolist(), strict=True)])
            yield pa.array(rows, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    compared = met.join(left, ["centre", "one"]).join(right, ["centre", "other", "two"])
    return compared.select(F.explode(links("x", "y")).alias("link")).select("link.a", "link.b").distinct()


def near_duplicates(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(doc, n, component, kept) of every row: set size, smallest document reachable, and whether it is that.

    The set of a text are its distinct ``words``-word shingles (all words as one if there are fewer),
    A-Z lower-cased. Texts are linked if 100 * intersection >= ``percent`` * union of whole sets.
    With 32 bands of 5 rows a pair at 0.8 shares a band with probability 1 - 3e-6.

    Equal sets are one class from the start, and only its smallest document goes on; so copies never
    meet in a bucket. In a bucket each class is compared with one centre, and linked classes become one
    component. Members of a centre's buckets that are then still apart are compared with all its other
    members, in blocks; so no link between different sets is lost, and near copies that are linked to
    their centre cost one comparison each. Sets are made only of documents that share a bucket; ids,
    sets, links and components stay in tables, none is collected or broadcast by hint.

    Null or empty text, or white space only: empty set, linked with nothing. Rows without key are
    linked with nothing: no component, kept. Repeated rows of a key fall into one class; if rows of one
    key differ in text, one of them is compared and the others have only their copies. Very long texts are
    compared whole, and a word of any length is one word. Empty table: no
    rows. Extra columns are not read.
    """
    profiles = stored(_profiles(documents, words, bands, rows, text, key), "minhash-profiles")
    named = profiles.filter("n > 0 and doc is not null")
    # Stored, so that the joins with it have an exchange on both sides and can split a hot class.
    classes = stored(named.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep")), "minhash-classes")
    heads = (
        named.join(classes.withColumnRenamed("rep", "doc"), ["doc", "n", "s1", "s2"], "left_semi")
        .groupBy("doc")
        .agg(F.min(F.struct("n", "s1", "s2", "bands")).alias("head"))
        .select("doc", "head.n", F.explode("head.bands").alias("key"))
    )
    shared = heads.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    members = stored(heads.join(shared, "key", "left_semi"), "minhash-buckets")
    ids = members.select("doc").distinct()
    sets = stored(_sets(documents, ids, words, text, key).dropDuplicates(["doc"]), "minhash-sets")

    # A group is a centre, the smallest document of some buckets, and all that share those with it.
    centres = members.groupBy("key").agg(F.min("doc").alias("centre"))
    centres = stored(centres, "minhash-centres")
    groups = stored(members.join(centres, "key").select("centre", "doc", "n").distinct(), "minhash-groups")
    sizes = groups.filter("doc = centre").select("centre", F.col("n").alias("centre_n"))
    small, large = F.least("n", "centre_n"), F.greatest("n", "centre_n")
    stars = (
        groups.join(sizes, "centre")
        .filter((F.col("doc") != F.col("centre")) & (100 * small >= percent * large))
        .select(F.col("centre").alias("a"), F.col("doc").alias("b"))
    )
    # Stored, so that the join with the sets deals the pairs anew and can split a hot centre.
    links = stored(_linked(stored(stars, "minhash-stars"), sets, percent), "minhash-links")
    labels = components(links).withColumnRenamed("component", "found")
    known = groups.join(labels, "doc", "left").select(
        "centre", "doc", "n", F.coalesce("found", "doc").alias("component")
    )
    links = links.union(stored(_apart(known, sets, percent), "minhash-links"))
    labels = components(links).select(F.col("doc").alias("rep"), F.col("component").alias("found"))
    placed = profiles.join(classes, ["n", "s1", "s2"], "left").join(labels, "rep", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("found", "rep", "doc"))
    return placed.select("doc", "n", component.alias("component")).withColumn(
        "kept", F.coalesce(F.col("doc") == F.col("component"), F.lit(True))
    )


def op4_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by two-word shingles."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(documents, words=2).select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        "kept",
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: one document of each group, the one with the smallest id, unchanged.

    Rows without id, and rows that share one, are told apart by a digest of id and text, and come after
    all other ids: of rows equal in both one stays, and rows of one id with different texts are documents of
    their own. Null, empty or blank texts are linked with nothing. Very long texts are compared
    whole. Empty table: no rows. Extra columns stay as they are, whatever their names.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null")
    shared = stored(ids.select(F.col("doc_id").alias("_shared")), "minhash-shared-ids")
    rows = docs.select(F.struct("*").alias("document"), "doc_id", "text")
    unsure = F.col("doc_id").isNull()
    if not shared.isEmpty():
        rows = rows.join(shared, F.col("doc_id") == F.col("_shared"), "left")
        unsure = unsure | F.col("_shared").isNotNull()
    own = F.lit(OWN) + F.shiftrightunsigned(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), 2)
    rows = rows.select("document", "text", F.when(unsure, own).otherwise(F.col("doc_id").cast("long")).alias("_row"))
    gone = near_duplicates(rows, key="_row").filter("not kept").select(F.col("doc").alias("_row")).distinct()
    left = rows.join(gone, "_row", "left_anti").select("_row", "document")
    if not (shared.isEmpty() and docs.filter("doc_id is null").isEmpty()):
        own = F.col("_row") >= OWN
        left = left.filter(~own).unionAll(left.filter(own).dropDuplicates(["_row"]))
    return left.select("document.*")
