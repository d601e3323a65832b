"""Byte-level BPE by a sentencepiece model made from a table of ranks.

A table of ranks maps byte strings to numbers; of two neighbouring tokens those are merged first
whose joined bytes have the least rank. A sentencepiece model of kind BPE merges the neighbours
whose joined piece has the highest score. So a model whose pieces are the tokens, with each byte
written as one visible character and the negative rank as the score, makes the same merges. It is
serialised here field by field, with an identity normaliser that adds and removes nothing.

A text is cut by the table's pattern, and each piece of it is encoded by itself. A piece that is
a token as a whole is that token, whatever its merges would give. Ids are turned back into bytes
by the model's pieces and the inverse of the byte alphabet.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED = 1 << 19  # different pieces a worker remembers before it lets go of those not used since as many ago
REMEMBERED_CHARS = 64  # longer ones are not remembered
AT_ONCE = 1 << 16  # pieces encoded together, of one text or several; bounds what is held beside the texts
LONG = 1 << 20  # characters from which a text is cut bit by bit

UNKNOWN = "<unk>"

_DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def alphabet() -> list[str]:
    """A visible character for each byte: itself where it is one, else the next from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte) if byte in visible else chr(next(spare)) for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The table in a file of lines with a token in base64 and its rank.

    The file lies where the driver can open it, as in an installed package; the tasks get the
    model made from it and need no file.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


# A model in the wire format of protocol buffers


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


# Field and kind numbers of a sentencepiece model.
_PIECE, _TRAINER, _NORMALISER = 1, 2, 3
_PIECE_TEXT, _PIECE_SCORE, _PIECE_KIND = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_TRAINER_KIND, _TRAINER_SIZE, _TRAINER_UNKNOWN, _BPE = 3, 4, 40, 2
_NORMALISER_NAME, _ADD_PREFIX, _SQUEEZE_SPACE, _ESCAPE_SPACE = 1, 3, 4, 5


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a table; a piece's id is its rank.

    Ranks have to run from 0 without a gap, and every single byte has to be a token. The unknown
    piece a model needs comes last; no text can lead to it.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[token] for token in tokens] != list(range(len(tokens))):
        raise ValueError("ranks do not run from 0 without a gap")
    if any(bytes([byte]) not in ranks for byte in range(256)):
        raise ValueError("not every byte is a token")
    letters = alphabet()

    def piece(text: str, score: float, kind: int) -> bytes:
        fields = _bytes(_PIECE_TEXT, text.encode()) + _float(_PIECE_SCORE, score) + _number(_PIECE_KIND, kind)
        return _bytes(_PIECE, fields)

    pieces = [piece("".join(letters[byte] for byte in token), -rank, _NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(piece(UNKNOWN, 0, _UNKNOWN))
    trainer = _number(_TRAINER_KIND, _BPE) + _number(_TRAINER_SIZE, len(pieces)) + _number(_TRAINER_UNKNOWN, len(tokens))
    plain = b"".join(_number(field, 0) for field in (_ADD_PREFIX, _SQUEEZE_SPACE, _ESCAPE_SPACE))
    normaliser = _bytes(_NORMALISER_NAME, b"identity") + plain
    return b"".join(pieces) + _bytes(_TRAINER, trainer) + _bytes(_NORMALISER, normaliser)


class Codec:
    """Encodes texts by a serialised model and turns ids back into bytes."""

    def __init__(self, model: bytes, pattern: str):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._pattern = regex.compile(pattern)
        letters = alphabet()
        self._spelled = dict(enumerate(letters))  # bytes, read as Latin-1, to letters
        back = {ord(letter): byte for byte, letter in enumerate(letters)}
        size = self._model.get_piece_size() - 1
        texts = [self._model.id_to_piece(k) for k in range(size)]
        self.decimal = list(map(str, range(size)))
        self._bytes = [text.translate(back).encode("latin-1") for text in texts]
        self._whole = {token: (k,) for k, token in enumerate(self._bytes)}
        self._known: dict[str, tuple[int, ...]] = {}
        self._before: dict[str, tuple[int, ...]] = {}

    def _cut(self, text: str) -> Iterator[list[str]]:
        if len(text) < LONG:
            yield self._pattern.findall(text)
        else:
            found = (match[0] for match in self._pattern.finditer(text))
            while pieces := list(islice(found, AT_ONCE)):
                yield pieces

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known, all in one call."""
        if len(self._known) > REMEMBERED:
            self._known, self._before = {}, self._known
        spelled = {}
        for piece in pieces.difference(self._known):
            data = piece.encode()
            ids = self._before.get(piece) or self._whole.get(data)
            if ids:
                self._known[piece] = ids
            else:
                spelled[piece] = data.decode("latin-1").translate(self._spelled)
        if spelled:
            ids = self._model.encode(list(spelled.values()), out_type=int, num_threads=1)
            self._known.update(zip(spelled, map(tuple, ids)))

    def _encode(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[int]]]:
        pieces = set().union(*(some for _, some in held))
        self._learn(pieces)
        for k, some in held:
            yield k, list(chain.from_iterable(map(self._known.__getitem__, some)))
        for piece in pieces:
            if len(piece) > REMEMBERED_CHARS:
                del self._known[piece]

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, list[int]]]:
        """The number of a text and its ids, in order; a long text comes in several parts."""
        held, size = [], 0
        for k, text in enumerate(texts):
            for pieces in self._cut(text):
                held.append((k, pieces))
                size += len(pieces)
                if size >= AT_ONCE:
                    yield from self._encode(held)
                    held, size = [], 0
        yield from self._encode(held)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(model: bytes, pattern: str) -> Codec:
    """One per worker process; loading a model takes longer than encoding a text."""
    return Codec(model, pattern)


def encoded(docs: DataFrame, model: bytes, pattern: str) -> DataFrame:
    """``doc_id, ids`` with the ids of every whole text; null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model, pattern)
        for batch in batches:
            ids = [[] for _ in range(len(batch))]
            for k, some in coder.encode(batch["text"].fillna("")):
                ids[k] += some
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, model: bytes, pattern: str) -> DataFrame:
    """``doc_id, data`` with the bytes that ids stand for; null ids are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model, pattern)
        for batch in batches:
            data = [b"" if row is None else coder.decode(row) for row in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "data": data})

    rows = ids.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return rows.mapInPandas(run, "doc_id long, data binary")


def digests(docs: DataFrame, model: bytes, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text encoded and decoded.

    Ids go into the first digest in decimal with one blank between them, and the bytes they
    stand for into the second. A null text is an empty one: no ids, and both digests of nothing.
    Repeated rows and rows with a null ``doc_id`` come out once each, other columns are ignored,
    and no rows give no rows. A text of any length is encoded whole, some 65,000 pieces at a
    time. Nothing is shuffled; the model, about a megabyte, goes to the tasks with their code.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model, pattern)
        for batch in batches:
            found = pd.DataFrame(_digests(coder, batch["text"].fillna("").tolist()), columns=_DIGESTS)
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield found

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, _SCHEMA)


def _digests(coder: Codec, texts: list[str]) -> list[tuple[int, str, str]]:
    counts = [0] * len(texts)
    numbers, data = ([hashlib.sha256() for _ in texts] for _ in range(2))
    for k, ids in coder.encode(texts):
        if counts[k] and ids:
            numbers[k].update(b" ")
        numbers[k].update(" ".join(map(coder.decimal.__getitem__, ids)).encode())
        data[k].update(coder.decode(ids))
        counts[k] += len(ids)
    return [(n, a.hexdigest(), b.hexdigest()) for n, a, b in zip(counts, numbers, data)]
