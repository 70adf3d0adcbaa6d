"""Packing of examples into training sequences by vector bin packing.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. An example
longer than a sequence is cut into full pieces; what remains of it waits in a pool. Bins are
filled one at a time: of the pieces that fit in all three dimensions the one with the
largest dot product of its sizes and the room left (each as a share of its limit) goes in,
so that the dimension with most room is used most. If nothing fits and a gap of `CUT_FROM`
tokens or more is left, a waiting piece is cut to fill it. What the other limits close before it is
full, and the last sequence of a task, is cut at powers of two, lengths that need no padding.

Each task packs its own rows in one pass, without a shuffle and with a bounded pool; its waste
is a part of one sequence. Sequence ids carry the task's number, so they are unique, and a
task that runs again gives the same rows. Hot sources or copies do not matter to it.

Cases: a NULL text or NULL ids is the empty example, which for documents still has its end id; an
example without ids gives no piece. Keys may repeat or be NULL. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.bpe import REMEMBERED, Spec, WordTable, byte_letters, keyed_texts

#: Pieces that wait at most, and the least gap for which a piece is cut.
POOL, CUT_FROM = 2048, 8


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Piece:
    """Consecutive ids of an example; `loss` marks the ids that bear loss, None is all of them."""

    key: object
    start: int
    ids: bytes
    loss: np.ndarray | None
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def weight(self) -> int:
        return len(self) if self.loss is None else int(self.loss.sum())

    def fitting(self, tokens: int, loss: int) -> int:
        """Length of the longest head within the limits."""
        most = min(tokens, len(self))
        if self.loss is None:
            return min(most, loss)
        return int(np.searchsorted(np.cumsum(self.loss[:most]), loss, side="right"))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        first = None if self.loss is None else self.loss[:at]
        rest = None if self.loss is None else self.loss[at:]
        return (
            Piece(self.key, self.start, self.ids[: 4 * at], first, self.total),
            Piece(self.key, self.start + at, self.ids[4 * at :], rest, self.total),
        )


class Packer:
    """Fills sequences from a pool of waiting pieces."""

    def __init__(self, limits: Limits, first_id: int):
        self.limits, self.next_id = limits, first_id
        self.bounds = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pieces: list[Piece | None] = [None] * POOL
        self.sizes = np.zeros((POOL, 3))
        self.free = list(range(POOL))
        self.rows: list[tuple] = []

    def emit(self, bin_: list[Piece]) -> None:
        at = 0
        for piece in bin_:
            self.rows.append((piece.key, piece.start, len(piece), piece.ids, piece.total, self.next_id, at))
            at += len(piece)
        self.next_id += 1

    def emit_cut(self, bin_: list[Piece]) -> None:
        """The bin as sequences whose lengths are powers of two, the longest first."""
        left = sum(map(len, bin_))
        while left:
            want, now = 1 << (left.bit_length() - 1), []
            left -= want
            while want:
                piece = bin_.pop(0)
                if len(piece) > want:
                    piece, rest = piece.cut(want)
                    bin_.insert(0, rest)
                want -= len(piece)
                now.append(piece)
            self.emit(now)

    def close(self, bin_: list[Piece]) -> None:
        """A bin that is nearly full is padded, any other cut."""
        if sum(map(len, bin_)) + CUT_FROM > self.limits.tokens:
            self.emit(bin_)
        else:
            self.emit_cut(bin_)

    def put(self, slot: int, piece: Piece) -> None:
        self.pieces[slot] = piece
        self.sizes[slot] = len(piece), 1, piece.weight()

    def add(self, piece: Piece) -> None:
        """Full pieces leave at once; the rest waits."""
        while True:
            head = piece.fitting(self.limits.tokens, self.limits.loss)
            if head < 1 or head == len(piece) < self.limits.tokens:
                break
            full, piece = piece.cut(head) if head < len(piece) else (piece, None)
            self.close([full])
            if piece is None:
                return
        if not len(piece):
            return
        if not self.free:
            while len(self.free) < POOL // 2:
                self.close(self.filled())
        self.put(self.free.pop(), piece)

    def filled(self) -> list[Piece]:
        """One bin: the best dot product first, then a cut piece for the gap."""
        room, bin_ = self.bounds.copy(), []
        while room[0] >= 1 and room[1] >= 1 and len(self.free) < POOL:
            fits = (self.sizes[:, 0] > 0) & (self.sizes <= room).all(axis=1)
            scores = np.where(fits, self.sizes @ (room / self.bounds**2), -1.0)
            slot = int(scores.argmax())
            if scores[slot] >= 0:
                piece = self.pieces[slot]
                room -= self.sizes[slot]
                self.sizes[slot], self.pieces[slot] = 0, None
                self.free.append(slot)
                bin_.append(piece)
                continue
            if bin_ and room[0] < CUT_FROM:
                break
            slot = int(self.sizes[:, 0].argmax())
            head = self.pieces[slot].fitting(int(room[0]), int(room[2]))
            if not head:
                break
            piece, rest = self.pieces[slot].cut(head)
            self.put(slot, rest)
            bin_.append(piece)
            break
        return bin_

    def end(self) -> None:
        """Packs what waits; the last sequence is cut at powers of two."""
        while len(self.free) < POOL:
            bin_ = self.filled()
            if len(self.free) < POOL:
                self.close(bin_)
            else:
                self.emit_cut(bin_)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _packed(schema: T.StructType, limits: Limits, read: Callable[[pa.RecordBatch], Iterator[tuple]]):
    """The map over the rows of a task; `read` gives (key, ids, loss marks) of each row of a batch."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for key, ids, loss in read(batch):
                packer.add(Piece(key, 0, ids, loss, len(ids) // 4))
                if len(packer.rows) >= 4096:
                    yield table(packer.taken(), key_type)
        packer.end()
        if rows := packer.taken():
            yield table(rows, key_type)

    def table(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    return apply


def _schema(key: T.StructField) -> T.StructType:
    schema = T.StructType([key]).add("start", "long").add("length", "long").add("ids", "binary")
    return schema.add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")


def pack_examples(
    examples: DataFrame, limits: Limits | None = None, id_col: str = "doc_id", ids_col: str = "ids", loss_col: str | None = None
) -> DataFrame:
    """Pieces of tokenised examples: key, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    `loss_col` holds an array of booleans, one per id; NULL or no column means that all ids bear loss.
    """
    loss = F.col(loss_col) if loss_col else F.lit(None).cast("array<boolean>")
    rows = examples.select(id_col, F.col(ids_col).cast("array<bigint>").alias("_ids"), loss.alias("_loss"))

    def read(batch: pa.RecordBatch) -> Iterator[tuple]:
        for key, ids, marks in zip(*(batch.column(i) for i in range(3)), strict=True):
            held = np.array(ids.as_py() or [], "<u4")
            mask = None if marks.as_py() is None else np.array(marks.as_py(), bool)
            yield key.as_py(), held.tobytes(), mask

    schema = _schema(rows.schema[0])
    return rows.mapInArrow(_packed(schema, limits or Limits(), read), schema)


@cache
def library_encoder(path: str, remembered: int = REMEMBERED) -> WordTable:
    """Words encoded by the model of the tokenizers library; one per Python worker and tokenizer file."""
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(path).model, byte_letters()

    def encode(piece: str) -> list[int]:
        # Letters of bytes as the model knows them; printable ASCII stands for itself.
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode().decode("latin-1").translate(letters)
        return [token.id for token in model.tokenize(piece)]

    spec = Spec(path)
    # The library has the vocabulary; neither it nor token strings are needed to encode.
    del spec.model, spec.strings
    return WordTable(spec, encode, remembered)


def pack_documents(
    docs: DataFrame,
    path: str,
    limits: Limits | None = None,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """`pack_examples` over documents, tokenised with the file at `path` and ended by `end_id`; all ids bear loss.

    `remembered` bounds the words a worker holds between tasks: about 200 bytes each, two tables of them.
    """
    rows = keyed_texts(docs, id_col, text_col)
    end = np.array([end_id], "<u4").tobytes()

    def read(batch: pa.RecordBatch) -> Iterator[tuple]:
        texts = batch.column(1).to_pylist()
        for key, ids in zip(batch.column(0).to_pylist(), library_encoder(path, remembered).texts(texts), strict=True):
            yield key, ids + end, None

    schema = _schema(rows.schema[0])
    return rows.mapInArrow(_packed(schema, limits or Limits(), read), schema)
