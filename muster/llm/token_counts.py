"""Token counts on the map side: a broadcast table of pre-token lengths, and worker caches for misses."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from muster.llm.pretokens import CHUNK, Bounded, splitter
from muster.llm.tables import table
from muster.llm.workers import parts, worker_held

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MAX_TOKENS = 1024
# Bytes of the misses that a worker keeps.
CACHED = 100 << 20


def _special(model: dict) -> list[str]:
    """Strings that the library cuts out before it splits a text."""
    for token in model["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"only plain special tokens are known here: {token}")
    return [token["content"] for token in model["added_tokens"]]


def _checked(text: str) -> dict:
    model = json.loads(text)
    before = model["pre_tokenizer"]
    if model["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"]:
        raise ValueError("a byte-level vocabulary without normaliser is expected")
    if model["truncation"] or model["padding"] or not before["use_regex"]:
        raise ValueError("truncation, padding and other splits are not known here")
    return model


def frequent_lengths(text: str) -> dict[str, int]:
    """Tokens of each vocabulary entry that is a pre-token by itself.

    A vocabulary holds the words that were most frequent where it was trained. Its size bounds the
    broadcast, whatever the corpus.
    """
    tokenizer, model = Tokenizer.from_str(text), _checked(text)
    split, special = splitter(public_tokenizers.PATTERN), set(_special(model))
    entries = [tokenizer.decode([i]) for i in model["model"]["vocab"].values()]
    alone = [e for e in entries if e and "�" not in e and e not in special and next(split(e)) == [e]]
    encoded = tokenizer.encode_batch(alone, add_special_tokens=False)
    return {entry: len(e.ids) for entry, e in zip(alone, encoded, strict=True)}


def count_tokens(
    documents: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", limit: int = MAX_TOKENS
) -> DataFrame:
    """``document`` (the row as a struct), ``n_bytes``, ``n_tokens`` and ``over_limit`` of every text.

    Counts are those of the tokenizers library for the file at ``vocabulary`` without added tokens:
    special strings inside a text are cut out first and count one each. What is left is split into
    pre-tokens, whose lengths add up. Nothing is shuffled: lengths come from a broadcast table, one
    entry per vocabulary entry at most, and each Python worker encodes what is missing there, a batch
    at a time, and keeps it in a cache of bounded size.

    Null or empty text: no bytes, no tokens. Very long texts are split in steps of bounded length.
    Empty table: no rows. Extra columns stay inside ``document``, whatever their names.
    """
    serial = Path(vocabulary).read_text()
    special = _special(_checked(serial))
    sent = documents.sparkSession.sparkContext.broadcast((serial, frequent_lengths(serial)))
    cut = "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)"

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        serial, lengths = sent.value
        tokenizer = worker_held(f"tokenizer {vocabulary}", lambda: Tokenizer.from_str(serial))
        cache = worker_held(f"lengths {vocabulary}", lambda: Bounded(lengths, CACHED))
        split, marks = splitter(public_tokenizers.PATTERN), regex.compile(cut)

        def encode(tokens: list[str]) -> list[int]:
            return [len(e.ids) for e in tokenizer.encode_batch(tokens, add_special_tokens=False)]

        def length(lists: list[list[str]]) -> int:
            return sum(sum(map(cache.__getitem__, tokens)) for tokens in lists)

        for batch in batches:
            totals: list[int] = []
            for part in parts(batch):
                waiting = []
                for value in part.to_pylist():
                    rest = marks.split(value)
                    total, held = len(rest) - 1, []
                    for tokens in chain.from_iterable(map(split, rest)):
                        held.append(tokens)
                        if sum(map(len, held)) >= CHUNK:
                            cache.learn(held, encode)
                            total, held = total + length(held), []
                    totals.append(total)
                    waiting.append((len(totals) - 1, held))
                cache.learn([tokens for _, held in waiting for tokens in held], encode)
                for place, held in waiting:
                    totals[place] += length(held)
            yield pa.array(totals, pa.int64())

    given = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.struct("*").alias("document"),
        F.octet_length(given).cast("long").alias("n_bytes"),
        counted(given).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(documents).select("document.doc_id", "n_bytes", "n_tokens", "over_limit")
