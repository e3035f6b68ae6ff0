"""Byte-level BPE through a sentencepiece model that is written from the vocabulary."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from muster.llm.pretokens import CHUNK, Bounded, splitter
from muster.llm.tables import table
from muster.llm.workers import parts, worker_held

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Bytes of the pre-tokens that a worker keeps.
CACHED = 72 << 20
BPE, NORMAL, UNKNOWN = 2, 1, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is a visible one, else from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


def serialise(ranks: dict[bytes, int]) -> bytes:
    """Sentencepiece BPE model of a vocabulary: byte-mapped pieces scored by negative rank.

    The best-scored adjacent pair merges first, the leftmost of equals, which is the order of merges
    by rank. There is no normalisation, no added space and no escaped one. Piece 0 is the unknown
    piece, which never occurs since all bytes are pieces.
    """
    if sum(len(t) == 1 for t in ranks) != 256:
        raise ValueError("the vocabulary must hold all single bytes")
    letters = byte_letters()
    model = ModelProto()
    model.pieces.add(piece="<unk>", score=0, type=UNKNOWN)
    for token in sorted(ranks, key=ranks.__getitem__):
        piece = "".join(letters[b] for b in token)
        model.pieces.add(piece=piece, score=-ranks[token], type=NORMAL)
    model.trainer_spec.model_type = BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes pre-tokens to ranks, and ranks back to bytes."""

    def __init__(self, serial: bytes, ranks: list[int]):
        self.processor = SentencePieceProcessor(model_proto=serial)
        self.ranks = ranks
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        of_letter = {c: b for b, c in self.letters.items()}
        pieces = map(self.processor.id_to_piece, range(1, len(ranks) + 1))
        self.bytes_of = {r: bytes(of_letter[c] for c in p) for r, p in zip(ranks, pieces, strict=True)}
        self.digits = {r: str(r).encode() for r in ranks}
        self.whole = {token: rank for rank, token in self.bytes_of.items()}

    def encode(self, tokens: list[str]) -> list[tuple[int, ...]]:
        """Ranks of each pre-token: the entry that it is, else the merges."""
        found: list[tuple[int, ...] | None] = []
        for token in tokens:
            rank = self.whole.get(token.encode())
            found.append(None if rank is None else (rank,))
        mapped = [
            t.encode().decode("latin-1").translate(self.letters)
            for t, f in zip(tokens, found, strict=True) if f is None
        ]
        merged = iter(self.processor.encode(mapped, out_type=int, num_threads=1) if mapped else [])
        return [f if f is not None else tuple(self.ranks[i - 1] for i in next(merged)) for f in found]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def entries(self, tokens: list[str]) -> list[tuple[bytes, bytes]]:
        """What the cache holds of each pre-token: its ids as text, and the bytes they decode to."""
        return [
            (b",".join(map(self.digits.__getitem__, ids)), self.decode(ids))
            for ids in self.encode(tokens)
        ]


def encode_documents(documents: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``document`` (the row as a struct) and ``bpe``: ``n_tokens``, and digests of ids and decoded bytes.

    Each match of the public split pattern is encoded separately, as tiktoken does for the same ranks,
    and the ids are decoded again by the inverse mapping, both once per pre-token that a worker's cache
    doesn't hold; a text's ids and bytes are those of its pre-tokens. Nothing is shuffled; the broadcast
    model is bounded by the vocabulary, and a worker's cache of pre-tokens by a number of
    entries. ``bpe.ids`` holds the ids themselves (pruned where it is not read).

    Null or empty text: no tokens; digests of nothing. Very long texts are split in steps of bounded
    length. Empty table: no rows. Extra columns stay inside ``document``, whatever their names.
    """
    return _encoded(documents, vocabulary, text, with_ids=True)


def _encoded(documents: DataFrame, vocabulary: str, text: str, with_ids: bool) -> DataFrame:
    ranks = read_ranks(vocabulary)
    sent = documents.sparkSession.sparkContext.broadcast((serialise(ranks), sorted(ranks.values())))
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    names = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.arrow_udf(names)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = worker_held(f"codec {vocabulary}", lambda: Codec(*sent.value))
        cache = worker_held(f"ids {vocabulary}", lambda: Bounded({}, CACHED))
        split = splitter(public_tokenizers.PATTERN)
        for batch in batches:
            rows = []
            for part in parts(batch):
                rows += _digests(part.to_pylist(), split, cache, codec, with_ids)
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            yield pa.StructArray.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)],
                names=[name for name, _ in fields],
            )

    given = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.struct("*").alias("document"), encoded(given).alias("bpe"))


def _digests(values: list[str], split, cache: Bounded, codec: Codec, with_ids: bool) -> list[tuple]:
    """Digests of texts. The short ones are learnt together, and read before the next call of ``learn``.

    That call may turn the cache over, and what it doesn't ask for is then no longer held.
    """
    lists = [next(split(v), []) if len(v) <= CHUNK else None for v in values]
    cache.learn([found for found in lists if found is not None], codec.entries)
    rows = [None if found is None else _digest([found], cache, with_ids) for found in lists]
    return [
        _digest(_learnt(split(value), cache, codec), cache, with_ids) if row is None else row
        for value, row in zip(values, rows, strict=True)
    ]


def _learnt(steps: Iterable[list[str]], cache: Bounded, codec: Codec) -> Iterator[list[str]]:
    """The pre-tokens of a long text step by step, each learnt as it is asked for."""
    for tokens in steps:
        cache.learn([tokens], codec.entries)
        yield tokens


def _digest(steps: Iterable[list[str]], cache: Bounded, with_ids: bool) -> tuple:
    """Joins what the cache holds step by step: digests of the ids and of the bytes that they decode to."""
    ids_sha, bytes_sha, total, all_ids = hashlib.sha256(), hashlib.sha256(), 0, []
    for tokens in steps:
        if not tokens:
            continue
        entries = list(map(cache.__getitem__, tokens))
        text = b",".join([ids for ids, _ in entries])
        ids_sha.update(b"," + text if total else text)
        bytes_sha.update(b"".join([decoded for _, decoded in entries]))
        total += text.count(b",") + 1
        if with_ids:
            all_ids += map(int, text.split(b","))
    row = (total, ids_sha.hexdigest(), bytes_sha.hexdigest())
    return (*row, all_ids) if with_ids else row


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document encoded and decoded."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = _encoded(documents, VOCABULARY, "text", with_ids=False)
    return found.select("document.doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage, the last: documents with their number of tokens and the digests.

    Null text: no tokens, as an empty one. Repeated rows give equal rows. Very long texts are encoded whole, in
    steps. Empty table: no rows. Extra columns stay as they are.
    """
    found = _encoded(docs, VOCABULARY, "text", with_ids=False)
    return found.select("document.*", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")
