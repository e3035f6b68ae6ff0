"""Hard negatives by segment summaries: exact scores only where bounds leave the outcome open.

A vector is cut into segments; of each its mean and its deviation (the norm of what is left without the
mean) are stored. The inner product of two segments is their size times the product of the means, plus
or minus at most the product of the deviations. So a few numbers bound a score; pairs that the bounds of
one level leave open go to finer segments, and what is then still open to the exact product.

Anchors are taken in blocks of a fixed size, one after the other; a block goes to all tasks, and each
task keeps the best rows for it. Rows are searched in waves, each some times larger than the ones
before: what a wave has found bounds what the next one needs to look at, so tasks return few rows however
many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.tables import stored, table
from muster.session import shared_folder

POSITIVES = NEGATIVES = 5
LOW_PERCENT = 80
SCALE = 256
# Segments of a vector at each level.
LEVELS = (1, 4, 16)
ANCHORS = 4096
FIRST_WAVE, GROWTH = 8192, 16
# Pairs of a tile, and numbers of a step over open pairs.
TILE, STEP = 1 << 20, 1 << 22
# Bounds are widened by this part of the product of the norms, far above what rounding can add up to.
SLACK = 1e-9
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

SUMMARY = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("label", T.LongType()),
        T.StructField("codes", T.ArrayType(T.LongType())),
        T.StructField("means", T.ArrayType(T.DoubleType())),
        T.StructField("deviations", T.ArrayType(T.DoubleType())),
    ]
)
FOUND = "anchor long, positive long, positive_score long, key long, score long"


def summaries(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means (times the root of the segment's size) and deviations of all levels' segments, side by side."""
    means, deviations = [], []
    for count in LEVELS:
        cut = codes.astype(np.float64).reshape(len(codes), count, codes.shape[1] // count)
        mean = cut.mean(axis=2)
        deviations.append(np.sqrt(np.square(cut - mean[:, :, None]).sum(axis=2)))
        means.append(mean * np.sqrt(cut.shape[2]))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


@dataclass
class Rows:
    """Rows of a summary table as arrays."""

    key: np.ndarray
    label: np.ndarray
    codes: np.ndarray
    means: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, columns: list[pa.Array]) -> Rows:
        key, label, *lists = columns
        n = len(key)
        flat = (c.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in lists)
        return cls(key.to_numpy(zero_copy_only=False), label.to_numpy(zero_copy_only=False), *flat)

    def slice(self, at: int, to: int) -> Rows:
        return Rows(*(c[at:to] for c in (self.key, self.label, self.codes, self.means, self.deviations)))


def _dots(a: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows: of all rows at once if most are asked for."""
    if 8 * len(i) > len(a) * len(x):
        return (a @ x.T)[i, j]
    step = max(1, STEP // max(1, a.shape[1]))
    some = [(a[i[s : s + step]] * x[j[s : s + step]]).sum(axis=1) for s in range(0, len(i), step)]
    return np.concatenate([*some, np.zeros(0, a.dtype)])


def _exact(a: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them exactly unless they are very large."""
    largest = [int(max(c.max(initial=0), -int(c.min(initial=0)))) for c in (a, x)]
    if largest[0] * largest[1] * a.shape[1] < 1 << 53:
        return _dots(a.astype(np.float64), x.astype(np.float64), i, j).astype(np.int64)
    whole = _dots(a.astype(object), x.astype(object), i, j)
    return np.array([min(max(v, LEAST), MOST) for v in whole], np.int64)


def _open(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles; the ends of the 64 bits stand for all that lies beyond them."""
    out = scores.astype(np.float64)
    out[scores == LEAST], out[scores == MOST] = -np.inf, np.inf
    return out


class Search:
    """The best rows of each query: an anchor, a range of scores, and whether labels agree.

    ``low`` and ``high`` are (anchor, query) grids; a query that isn't there has an empty range. ``known``
    is the score that a row needs at least, from earlier waves.
    """

    def __init__(self, anchors: Rows, low: np.ndarray, high: np.ndarray, known: np.ndarray, agree: bool, best: int):
        self.anchors, self.low, self.high, self.agree, self.best = anchors, low, high, agree, best
        self.need = np.maximum(low, known)
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.int64)

    def add(self, rows: Rows) -> None:
        step = max(1, TILE // max(1, len(self.anchors.key)))
        for at in range(0, len(rows.key), step):
            self._tile(rows.slice(at, at + step))

    def _tile(self, rows: Rows) -> None:
        a = self.anchors
        some = self.need <= self.high
        least = np.where(some, _open(self.need), np.inf).min(axis=1)
        most = np.where(some, _open(self.high), -np.inf).max(axis=1)
        open_ = (a.label[:, None] == rows.label[None, :]) == self.agree
        open_ &= (a.key[:, None] != rows.key[None, :]) & some.any(axis=1)[:, None]
        i, j = np.nonzero(open_)
        at, norms = 0, [np.hypot(c.means[:, 0], c.deviations[:, 0]) for c in (a, rows)]
        for count in LEVELS:
            part = slice(at, at + count)
            at += count
            middle = _dots(a.means[:, part], rows.means[:, part], i, j)
            reach = _dots(a.deviations[:, part], rows.deviations[:, part], i, j)
            reach += SLACK * (norms[0][i] * norms[1][j] + 1)
            stays = (middle + reach >= least[i]) & (middle - reach <= most[i])
            i, j = i[stays], j[stays]
        scores = _exact(a.codes, rows.codes, i, j)
        found = []
        for k in range(self.low.shape[1]):
            fits = (scores >= self.need[i, k]) & (scores <= self.high[i, k])
            found.append((i[fits] * self.low.shape[1] + k, scores[fits], rows.key[j[fits]]))
        self._keep(*map(np.concatenate, zip(*found, strict=True)))

    def _keep(self, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(query):
            return
        query, score, key = (
            np.concatenate(c) for c in ((self.query, query), (self.score, score), (self.key, key))
        )
        order = np.lexsort((key, -np.maximum(score, -MOST), query))
        query, score, key = query[order], score[order], key[order]
        # Repeated rows of a key count once.
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (score[1:] != score[:-1]) | (key[1:] != key[:-1])
        query, score, key = query[new], score[new], key[new]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        stays = place < self.best
        self.query, self.score, self.key = query[stays], score[stays], key[stays]
        full = place == self.best - 1
        grid = self.need.reshape(-1)
        grid[query[full]] = np.maximum(grid[query[full]], score[full])


def _summarised(rows: DataFrame, size: int) -> DataFrame:
    """``SUMMARY`` of (key, label, codes); vectors are filled up with zeros to ``size``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            codes = np.zeros((len(lengths), size), np.int64)
            codes[np.arange(size) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            columns = [
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(c) + 1, dtype=np.int32) * c.shape[1]), pa.array(c.reshape(-1))
                )
                for c in (codes, *summaries(codes))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=SUMMARY.names)

    return rows.mapInArrow(summarise, SUMMARY)


def _best(found: DataFrame, best: int) -> DataFrame:
    """The first rows of each query by score, then key; each wave's tasks return few rows of one."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "key")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= best)


def _searched(waves: list[DataFrame], anchors: Rows, queries: pa.Table | None, best: int) -> DataFrame:
    """The best rows of each query over all waves, with columns of ``FOUND`` and ``rank``.

    Without ``queries`` the anchors' own labels are searched; with them, (anchor, key, score) of positives,
    the other labels, for scores from ``LOW_PERCENT`` per cent of the positive's up to it.
    """
    spark = waves[0].sparkSession
    n = len(anchors.key)
    if queries is None:
        width = 1
        low, high = np.full((n, 1), LEAST), np.full((n, 1), MOST)
        names = scores = None
    else:
        at = np.searchsorted(anchors.key, queries["anchor"].to_numpy())
        order = np.argsort(at, kind="stable")
        at = at[order]
        width = int(np.bincount(at).max(initial=1))
        place = at, np.arange(len(at)) - np.searchsorted(at, at)
        names, scores = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
        names[place], scores[place] = (queries[c].to_numpy()[order] for c in ("key", "score"))
        low, high = np.full((n, width), MOST), np.full((n, width), LEAST)
        low[place] = [-(-LOW_PERCENT * s // 100) for s in scores[place].tolist()]
        high[place] = scores[place]
    schema = T.StructType.fromDDL(FOUND)
    known, whole = np.full((n, width), LEAST), None
    for wave in waves:
        held = spark.sparkContext.broadcast((anchors, low, high, known, queries is None, best, names, scores))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            *given, names, scores = held.value
            found = Search(*given)
            for batch in batches:
                if len(batch):
                    found.add(Rows.of(batch.columns))
            i, k = np.divmod(found.query, found.low.shape[1])
            none = pa.nulls(len(i), pa.int64())
            columns = [
                pa.array(found.anchors.key[i]),
                none if names is None else pa.array(names[i, k]),
                none if names is None else pa.array(scores[i, k]),
                pa.array(found.key),
                pa.array(found.score),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        found = wave.select(SUMMARY.names).mapInArrow(search, schema)
        if whole is not None:
            found = found.union(whole.drop("rank"))
        whole = stored(_best(found, best), "negatives-best")
        held.destroy()
        last = whole.filter(F.col("rank") == best).toArrow()
        if wave is not waves[-1] and len(last):
            i = np.searchsorted(anchors.key, last["anchor"].to_numpy())
            score = last["score"].to_numpy()
            if names is None:
                known[i, 0] = score
            else:
                same = names[i] == last["positive"].to_numpy()[:, None]
                known[i] = np.where(same & (low[i] <= high[i]), score[:, None], known[i])
    return whole


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score): negatives just below a positive.

    Components count as whole 256ths, rounded down. An anchor's positives are its ``positives`` best
    other rows of its label by inner product (ties: smaller key). For each, the ``negatives`` best rows
    of other labels whose score is at most the positive's, and at least 80 per cent of it; ``rank`` from 1.

    Each block of ``ANCHORS`` anchors is two searches over all rows; a block, its positives and its bounds
    pass through the driver and are broadcast (a few MB at a fixed length of vectors), nothing else does.
    A wave is a part of the rows by a hash of the key; all waves together are all rows.

    Rows with a null key or label, or a null, null-holding or not finite vector take no part. Vectors of
    different lengths are filled up with zeros. Repeated rows of a key and score count once; of different
    anchor rows of one key the one of least label and vector counts. Scores beyond 64 bits are cut to
    them. Empty table, or no anchors: no rows. Extra columns are not read.
    """
    spark = vectors.sparkSession
    value = F.col(vector)
    rows = vectors.select(
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("long").alias("label"),
        F.transform(value, lambda x: F.floor(SCALE * x.cast("double"))).alias("codes"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))).alias("whole"),
    ).filter("key is not null and label is not null and whole")
    n, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("codes")), F.lit(0))).first()
    size = -(-max(1, length) // LEVELS[-1]) * LEVELS[-1]
    count, room = 1, FIRST_WAVE
    while room < n:
        count, room = count + 1, room * GROWTH
    # Wave w has every GROWTH**w-th row, less those of the waves above it; the last above is searched first.
    draw = F.pmod(F.xxhash64("key"), F.lit(GROWTH ** (count - 1)))
    wave = F.lit(0)
    for w in range(1, count):
        wave = F.when(draw % GROWTH**w == 0, w).otherwise(wave)
    path = shared_folder(spark, "negatives-rows")
    made = _summarised(rows.select("key", "label", "codes"), size).withColumn("wave", wave.cast("int"))
    made.write.partitionBy("wave").parquet(path)
    schema = T.StructType([*SUMMARY.fields, T.StructField("wave", T.IntegerType())])
    every = spark.read.schema(schema).parquet(path)
    waves = [every.filter(F.col("wave") == w) for w in reversed(range(count))]

    named = rows.filter("anchor").groupBy("key").agg(F.min(F.struct("label", "codes")).alias("row"))
    anchors = stored(_summarised(named.select("key", "row.label", "row.codes"), size), "negatives-anchors")
    out = shared_folder(spark, "negatives")
    result = T.StructType.fromDDL(FOUND + ", rank int")
    spark.createDataFrame([], result).write.parquet(out)
    last = None
    while True:
        rest = anchors if last is None else anchors.filter(F.col("key") > last)
        block = rest.orderBy("key").limit(ANCHORS).toArrow().combine_chunks()
        if not len(block):
            break
        some = Rows.of([c.chunk(0) for c in block.columns])
        last = int(some.key[-1])
        best = _searched(waves, some, None, positives)
        queries = best.select("anchor", "key", "score").toArrow()
        if len(queries):
            found = _searched(waves, some, queries, negatives)
            found.select(*result.names).write.mode("append").parquet(out)
    return spark.read.schema(result).parquet(out).select(
        "anchor", "positive", "rank", F.col("key").alias("negative"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all; every seventh label is first moved on."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def sql() -> str:
    return f"""
with rows as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
    [floor({SCALE} * cast(x as double)) for x in embedding] as codes
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
), scored as (
  select a.vec_id as anchor_id, a.label = r.label as agree, r.vec_id,
    cast(list_inner_product(a.codes, r.codes) as bigint) as score
  from rows a join rows r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where agree
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}
)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives p join scored s using (anchor_id)
where not agree and {LOW_PERCENT} * positive_score <= 100 * score and score <= positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= {NEGATIVES}"""
