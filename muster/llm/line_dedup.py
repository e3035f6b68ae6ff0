"""Lines that many documents share are dropped from all but the last of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.tables import stored, table

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit digest of the stripped line with A-Z lower-cased; None for a short one."""
    stripped = line.strip(BLANK)
    if len(stripped) < min_chars:
        return None
    return hashlib.blake2b(stripped.encode().lower(), digest_size=16).digest()


def _keys_of(text: str, min_chars: int) -> list[bytes]:
    return list({k for k in (line_key(line, min_chars) for line in text.split("\n")) if k is not None})


def dedup_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``document`` (the row as a struct) and ``lines``: ``n_lines``, ``n_dropped`` and the ``kept`` text.

    A text is split at \\n. The key of a line is the line stripped of ASCII white space with A-Z
    lower-cased. Keys of ``min_chars`` code points or more that occur in ``min_documents`` documents or
    more lose all their lines, but for those in the largest ``key`` that holds them.

    Lines leave a document as distinct 128-bit digests. Digests are counted over distinct (digest,
    document) pairs with partial sums before each shuffle, so a line that a third of all documents
    hold meets in no task; the join back is one that adaptive execution splits. A document's list of
    dropped digests is at most as long as the document, and texts are reassembled by position.

    Null or empty text: one empty line, kept. Repeated rows of a key count as one document and are cut
    alike. Rows without key count as one document, which is never the largest. Very long texts and lines are
    taken whole, a text by one worker. Empty table: no rows.
    Extra columns stay inside ``document``, whatever their names.
    """
    given = documents.select(
        F.struct("*").alias("document"),
        F.col(key).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )

    @F.arrow_udf("array<binary>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_keys_of(t, min_chars) for t in batch.to_pylist()], pa.list_(pa.binary()))

    found = given.select("_key", F.explode(keys("_text")).alias("digest"))
    shared = (
        found.distinct()
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("_key").alias("last"))
        .filter(F.col("n") >= min_documents)
        .select("digest", "last")
    )
    # From a stored table the join below has an exchange on both sides, and a hot line can be split.
    shared = stored(shared, "shared-lines")
    dropped = (
        found.join(shared, "digest")
        .filter(~F.col("_key").eqNullSafe(F.col("last")))
        .groupBy("_key")
        .agg(F.collect_set("digest").alias("drop"))
        .select(F.col("_key").alias("_cut"), "drop")
    )

    @F.arrow_udf("n_lines long, n_dropped long, kept string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            rows = []
            for value, drop in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
                lines = value.split("\n")
                gone = set(drop or ())
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["n_lines", "n_dropped", "kept"],
            )

    joined = given.join(dropped, F.col("_key").eqNullSafe(F.col("_cut")), "left")
    return joined.select("document", cut("_text", "drop").alias("lines"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every whole document, less those that three documents or more share."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(documents).select(
        "document.doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2("lines.kept", 256).alias("kept_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: all documents with their shared lines dropped and ``n_chars`` counted anew.

    Null text becomes an empty one. Repeated rows are cut alike, very long texts whole. Empty table: no rows.
    Extra columns stay as they are, whatever their names.
    """
    cut = dedup_lines(docs)
    new = {"text": F.col("lines.kept"), "n_chars": F.length("lines.kept").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*(new.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns))


def sql() -> str:
    return f"""
with docs as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from docs
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), shared as (
  select key, max(doc_id) as last from keyed where length(key) >= {MIN_CHARS}
  group by key having count(distinct doc_id) >= {MIN_DOCUMENTS}
), marked as (
  select k.doc_id, k.line, k.place, s.key is not null and s.last <> k.doc_id as gone
  from keyed k left join shared s on s.key = k.key
)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""
