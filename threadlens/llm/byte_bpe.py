"""Byte-level BPE encoding and decoding with a sentencepiece model.

The model is not trained: its protocol buffer is written straight from the
vocabulary.  Byte b stands as the character of code b (byte 0, which a piece
must not hold, as U+0100), so every token of the vocabulary is a piece of such
characters; its score is its negative rank, and the normalisation is the
identity.  sentencepiece joins the neighbours of the
highest score first, leftmost first, which is the rank order of byte-level
BPE.  Each match of the split pattern is encoded by itself; decoding maps ids
back to the bytes of their pieces.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import sliced_batches
from threadlens.llm.units import UNITS_KEPT, sliced_units

VOCABULARY = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 8 << 20

#: Wire types of a protocol buffer and the field numbers of sentencepiece's
#: model file (fixed values).
VARINT, BYTES, FLOAT = 0, 2, 5
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID, UNK_PIECE = 3, 4, 40, 41, 42, 43, 45
BPE = 2
NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5


def default_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | FLOAT) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3 | VARINT) + _varint(value)
    return _varint(number << 3 | BYTES) + _varint(len(value)) + value


def _characters(token: bytes) -> str:
    return token.decode("latin-1").replace("\0", "\u0100")


def _bytes(piece: str) -> bytes:
    return piece.replace("\u0100", "\0").encode("latin-1")


def model_file(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model of the vocabulary; its ids are the ranks.
    Every byte must be a token, so that nothing is ever unknown."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError(f"not a byte-level vocabulary of ranks 0, 1, ...: bytes without token {missing[:5]}")
    if len(ranks) >= 1 << 24:
        raise ValueError("the scores are 32-bit floats: ranks from 2^24 on are not exact")
    unknown = "⁇".encode()  # no byte stands as this character
    out = [_field(PIECES, _field(PIECE, _characters(token).encode()) + _field(SCORE, -float(rank))
                  + _field(TYPE, NORMAL))
           for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    out.append(_field(PIECES, _field(PIECE, unknown) + _field(SCORE, 0.0) + _field(TYPE, UNKNOWN)))
    trainer = [(MODEL_TYPE, BPE), (VOCAB_SIZE, len(ranks) + 1), (UNK_ID, len(ranks)), (BOS_ID, -1), (EOS_ID, -1),
               (PAD_ID, -1), (UNK_PIECE, unknown)]
    normalizer = [(NAME, b"identity"), (ADD_DUMMY_PREFIX, 0), (REMOVE_EXTRA_WHITESPACES, 0), (ESCAPE_WHITESPACES, 0)]
    out += [_field(TRAINER, b"".join(_field(*f) for f in trainer)),
            _field(NORMALIZER, b"".join(_field(*f) for f in normalizer))]
    return b"".join(out)


class Coder:
    """Encodes texts to ids and decodes ids to bytes, one per task."""

    def __init__(self, model: bytes, pattern: str, kept: int = UNITS_KEPT):
        import regex
        import sentencepiece
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        n = self.pieces.get_piece_size() - 1
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        self.bytes = list(map(_bytes, names))
        # a whole match that is a token is that token, also where no sequence of joins makes it
        self.whole = {name: [i] for i, (name, ids) in enumerate(zip(names, self.pieces.encode(names, num_threads=1)))
                      if ids != [i]}
        self.known: dict[str, bytes] = {}
        self.kept = kept

    def _learn(self, new: list[str]) -> None:
        """Ids of units not seen before, as little-endian 32-bit numbers."""
        matches = [self.split(u) for u in new]
        flat = [m if m.isascii() and "\0" not in m else _characters(m.encode()) for m in chain.from_iterable(matches)]
        ids = self.pieces.encode(flat, num_threads=1)
        if self.whole:
            ids = [self.whole.get(m, i) for m, i in zip(flat, ids)]
        numbers = np.fromiter(chain.from_iterable(ids), "<u4")
        per_match = np.cumsum([0, *map(len, ids)])
        ends = 4 * per_match[np.cumsum([0, *map(len, matches)])]
        packed, cuts = numbers.tobytes(), ends.tolist()
        self.known.update(zip(new, map(packed.__getitem__, map(slice, cuts, cuts[1:]))))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, each as 4 bytes, little-endian."""
        out = []
        for part in sliced_units(text):
            new = list({u for u in part if u not in self.known})
            if new:
                if len(self.known) + len(new) > self.kept:
                    self.known.clear()
                    new = list(set(part))
                self._learn(new)
            out.append(b"".join(map(self.known.__getitem__, part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _column(docs: DataFrame, path: str | None, pattern: str | None,
            work: Callable[[Coder], Callable], name: str) -> Column:
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((model_file(read_ranks(path or default_path())),
                                           pattern or default_pattern()))

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        each = work(Coder(*shared.value))
        for values in batches:
            yield pd.Series([each(v) for v in values], dtype="object")
    return run(F.col(name))


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text",
            ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids``: the tokens of the whole text, each id as
    4 bytes, little-endian.  ``path`` is a rank file, ``pattern`` splits a text
    into the matches that are encoded by themselves.

    Defined cases: a null text is the empty one, which has no ids; strings of
    special tokens are plain text; a column named as ``ids`` is replaced.  The
    model, whose size is the vocabulary's, is broadcast; rows stay where they
    are, nothing is shuffled.
    """
    whole = docs.withColumn(ids, F.coalesce(F.col(text).cast("string"), F.lit("")))
    return whole.withColumn(ids, _column(docs, path, pattern, lambda coder: coder.encode, ids))


def decoded(tokens: DataFrame, path: str | None = None, pattern: str | None = None, ids: str = "ids",
            to: str = "decoded") -> DataFrame:
    """``tokens`` with a binary column ``to``: the bytes that ``ids`` stand for
    (null ids: none)."""
    whole = tokens.withColumn(to, F.coalesce(F.col(ids), F.lit(b"")))
    return whole.withColumn(to, _column(tokens, path, pattern, lambda coder: coder.decode, to))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every document: ``encoded`` and ``decoded`` in
    one task, whose results go on in batches of about ``BATCH_BYTES``."""
    shared = docs.sparkSession.sparkContext.broadcast((model_file(read_ranks(path or default_path())),
                                                       pattern or default_pattern()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "ids", "decoded"])
        for batch in sliced_batches(batches):
            out, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = coder.encode(text or "")
                out.append((doc_id, ids, coder.decode(ids)))
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield batch_of(out)
                    out, held = [], 0
            if out:
                yield batch_of(out)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    rows = round_trip(docs, path, pattern)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
