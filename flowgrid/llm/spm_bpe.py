"""Byte-level BPE through a sentencepiece model written straight from a rank vocabulary.

Every token's bytes are mapped to printable characters, one per byte; the mapped piece is scored by its negative rank,
so sentencepiece merges the pair of lowest rank first, as byte-level BPE does. Normalisation is the identity. Texts are
split by the vocabulary's pattern and each match is encoded by itself; a match that is a token as a whole is that token.
Decoding maps pieces back to bytes. No tokenizer is trained.

Ids are carried as one binary of little-endian unsigned 32-bit integers per row.

Nulls and edges: a null text is empty; an empty text has no ids and decodes to no bytes; very long matches are encoded
whole and not kept in the memo; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgrid.llm.common import trimmed, with_columns

MEMO, MEMO_CHARS = 100_000, 64


def byte_chars() -> list[str]:
    """The printable character of each byte: itself if visible Latin-1, else the next free one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model; ids equal ranks, the obligatory unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    chars = byte_chars()
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    model = pb.ModelProto()
    for token in tokens:
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(ranks[token]))
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.trainer_spec.vocab_size = len(tokens) + 1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class _Memo(dict):
    """Packed ids by pre-token, filled on demand and emptied at a fixed size."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=model)
        unknown = self.pieces.unk_id()
        self.whole = {self.pieces.id_to_piece(i): i for i in range(unknown)}
        self.table = dict(enumerate(byte_chars()))

    def __missing__(self, token: str) -> bytes:
        mapped = token.encode().decode("latin-1").translate(self.table)
        own = self.whole.get(mapped)
        ids = self.pieces.encode(mapped) if own is None else [own]
        packed = np.array(ids, dtype="<u4").tobytes()
        if len(token) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[token] = packed
        return packed


def _encoder(model: bytes, pattern: str):
    import regex

    memo, find = _Memo(model), regex.compile(pattern).findall
    return lambda text: b"".join(map(memo.__getitem__, find(text)))


def _byte_table(model: bytes) -> list[bytes]:
    """The bytes of every id, by the inverse of the byte map."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_proto=model)
    back = {c: b for b, c in enumerate(byte_chars())}
    return [bytes(back[c] for c in pieces.id_to_piece(i)) for i in range(pieces.unk_id())]


def _extended(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of every whole text. Only the model (fixed by the vocabulary) is shipped to tasks."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _encoder(model.value, pattern)
        for batch in batches:
            packed = [one(t.as_py() or "") for t in batch.column(at)]
            yield with_columns(batch, **{ids: pa.array(packed, pa.binary())})

    return docs.mapInArrow(trimmed(run), _extended(docs, ids))


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its packed ids stand for."""
    model = encoded.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))
    at = encoded.columns.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(model.value)
        for batch in batches:
            back = [b"".join(map(table.__getitem__, np.frombuffer(i.as_py() or b"", "<u4").tolist())) for i in batch.column(at)]
            yield with_columns(batch, **{out: pa.array(back, pa.binary())})

    return encoded.mapInArrow(trimmed(run), _extended(encoded, out))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` (doc_id, text) with packed ids in place of the text, and what they decode to; both steps in one Python
    worker a task, so that an executor holds half as many."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, table = _encoder(model.value, pattern), _byte_table(model.value)
        for batch in batches:
            packed = [one(t.as_py() or "") for t in batch.column(1)]
            back = [b"".join(map(table.__getitem__, np.frombuffer(i, "<u4").tolist())) for i in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(back, pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    return docs.mapInArrow(trimmed(run), T.StructType([docs.schema["doc_id"], T.StructField("ids", T.BinaryType()),
                                              T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the packed ids and of the decoded bytes; on request the ids too."""
    both = round_trip(docs.select("doc_id", F.col("text").cast("string").alias("text")), ranks_path, pattern)
    return both.select("doc_id", F.expr("cast(octet_length(ids) div 4 AS bigint)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       *["ids"] * keep_ids)
