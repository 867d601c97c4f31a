"""Packing of tokenised examples into sequences: vector bin packing by the dot-product heuristic.

An example has three sizes: tokens, one segment, and loss-bearing tokens. In ``op4_packing`` the first of several lines is taken
for an instruction, whose tokens bear no loss; all others do. A sequence has a capacity in each. Whole
sequences are cut off an example while it has more tokens than a sequence holds; what is left goes to a pool of bounded
size. Into the open sequence goes, each time, the piece of the pool whose sizes have the greatest dot product with the
capacities that are left. When no piece fits, one is cut to fill the rest (if cutting is allowed), so that sequences
close full. At the end of a task the last sequence is split at powers of two, which need no padding.

Each task packs the documents that it reads, so nothing is shuffled, memory is bounded by the pool, and a task that
runs again on another executor gives the same rows. Sequence ids are the task's partition and a running number.

Ids are those of the ``tokenizers`` file. Given the same vocabulary as ranks, ``tiktoken`` finds them some four times faster.

Defined results: a null text is empty and has the end id alone; repeated rows are packed each by itself; texts of any length are
cut as often as it takes; of pieces that fit equally well the one that waits longest goes first; an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import importable, table
from .token_counts import tokenizer, tokenizer_path

#: A sequence's capacities: tokens, segments, loss-bearing tokens.
MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS = 2048, 48, 2040
#: Pieces that wait for a place, at most.
POOL = 512
END_ID = 1
#: Letters without a break beyond which a text goes to the library whose merges take n log n.
UNBROKEN = 2000

_ranked: dict = {}


class Encoder:
    """Ids of a text as little-endian 32-bit bytes.

    ``ranks`` names the same vocabulary for the faster library; it gives the same ids but reads special strings as text and
    slows down on pieces without a break, so texts with either are left to the first library.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self.tok = tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.fast = ranked(ranks) if ranks else None

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special) or len(text) > UNBROKEN and max(map(len, text.split())) > UNBROKEN:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


def ranked(path: str):
    if path not in _ranked:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ranked[path] = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ranked[path]


class Packer:
    """Takes examples, gives rows (doc, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, first_id: int, tokens: int, segments: int, loss: int, pool: int, cut: bool):
        self.cap = np.array([tokens, segments, loss], float)
        self.tokens, self.pool, self.cut, self.next = tokens, pool, cut, first_id
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []  # (doc, ids, loss mask, start, doc_tokens)
        self.sizes = np.zeros((0, 3))

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, ids, _, start, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, at))
            at += n
        self.next += 1

    def size(self, piece: tuple) -> tuple:
        return len(piece[1]) // 4, 1, int(piece[2].sum()) if piece[2] is not None else len(piece[1]) // 4

    def split(self, piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, ids, mask, start, total = piece
        return (doc, ids[: 4 * n], mask if mask is None else mask[:n], start, total), (doc, ids[4 * n :], mask if mask is None else mask[n:], start + n, total)

    def longest(self, piece: tuple, room: np.ndarray) -> int:
        """How many leading tokens of a piece the room left takes."""
        if room[1] < 1:
            return 0
        n = int(min(room[0], len(piece[1]) // 4))
        return min(n, int(room[2])) if piece[2] is None else int(np.searchsorted(np.cumsum(piece[2][:n]), room[2], side="right"))

    def add(self, doc, ids: bytes, mask: np.ndarray | None = None) -> None:
        # A view: each cut would otherwise copy all that is left of a long document.
        piece = (doc, memoryview(ids), mask, 0, len(ids) // 4)
        while (n := self.longest(piece, self.cap)) < len(piece[1]) // 4 or (n == self.tokens):
            if not self.cut and len(ids) // 4 > n:
                raise ValueError(f"document {doc}: {len(ids) // 4} tokens don't fit a sequence, and cutting is off")
            if not n:
                raise ValueError("a sequence's limits leave no room for a single token")
            head, piece = self.split(piece, n)
            self.close([head])
            if not piece[1]:
                return
        self.waiting.append((doc, bytes(piece[1]), mask if mask is None else piece[2].copy(), *piece[3:]))
        if len(self.waiting) >= self.pool:
            self.drain(self.pool // 2)

    def drain(self, until: int) -> None:
        """Packs sequences till at most ``until`` pieces wait."""
        waiting, sizes = self.waiting, np.array([self.size(p) for p in self.waiting], float).reshape(-1, 3)
        alive = np.ones(len(waiting), bool)
        left = len(waiting)
        while left > until:
            room, inside = self.cap.copy(), []
            while left:
                fits = alive & (sizes <= room).all(1)
                if fits.any():
                    score = np.where(fits, (sizes / self.cap) @ (room / self.cap), -1.0)
                    i = int(score.argmax())
                    inside.append(waiting[i])
                    room -= sizes[i]
                    alive[i] = False
                    left -= 1
                    continue
                if self.cut and room[0] >= 1:
                    i = int(np.where(alive, sizes[:, 0], -1).argmax())
                    if n := self.longest(waiting[i], room):
                        head, waiting[i] = self.split(waiting[i], n)
                        inside.append(head)
                        room -= self.size(head)
                        sizes[i] = self.size(waiting[i])
                break
            if not left and until == 0 and self.cut:
                self.tail(inside)
            else:
                self.close(inside)
        self.waiting = [p for p, a in zip(waiting, alive) if a]

    def tail(self, pieces: list[tuple]) -> None:
        """The last sequence of a task, split where powers of two end."""
        total = sum(len(p[1]) // 4 for p in pieces)
        while pieces:
            room = self.tokens if total >= self.tokens else 1 << (total.bit_length() - 1)
            total -= room
            inside = []
            while room:
                head, rest = self.split(pieces[0], min(room, len(pieces[0][1]) // 4))
                room -= len(head[1]) // 4
                inside.append(head)
                pieces = ([rest] if rest[1] else []) + pieces[1:]
            self.close(inside)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def first_line(text: str) -> str:
    """The first of several lines, with its end; empty where there is but one."""
    return text[: text.find("\n") + 1]


def pack_batches(batches: Iterator[pa.RecordBatch], path: str, ranks: str | None, kind: pa.DataType, end_id: int | None, limits: tuple, pool: int, cut: bool, prompts: bool = False) -> Iterator[pa.RecordBatch]:
    """Columns: _id, _text, and perhaps _no_loss, the number of leading tokens that bear no loss."""
    encode = Encoder(path, ranks)
    packer = Packer(TaskContext.get().partitionId() << 40, *limits, pool, cut)
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

    for b in batches:
        quiet = b.column(2).to_pylist() if b.num_columns > 2 else None
        for k, (doc, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            ids = encode(text or "") + end
            mask = None
            if prompts:
                no_loss = len(encode(first_line(text or ""))) // 4
                mask = (np.arange(len(ids) // 4) >= no_loss).astype(np.int64) if no_loss else None
            elif quiet is not None:
                mask = (np.arange(len(ids) // 4) >= (quiet[k] or 0)).astype(np.int64)
            if ids:
                packer.add(doc, ids, mask)
        if packer.rows:
            yield out(packer.taken())
    packer.drain(0)
    if packer.rows:
        yield out(packer.taken())


def pack(docs: DataFrame, path: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text", no_loss: str | None = None, prompts: bool = False, end_id: int | None = END_ID, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, pool: int = POOL, cut: bool = True) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``no_loss`` names a column with the number of leading tokens (an instruction's prompt) that bear no loss; with ``prompts`` the
    first of several lines is such a prompt. With
    ``cut`` false an example is never split, and one that fits no sequence is an error.
    """
    importable(docs.sparkSession)
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"), *([F.col(no_loss).cast("bigint").alias("_no_loss")] if no_loss else []))
    kind = d.schema["_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow, limits = to_arrow_type(kind), (max_tokens, max_segments, max_loss)
    return d.mapInArrow(
        lambda b: pack_batches(b, path, ranks, arrow, end_id, limits, pool, cut, prompts),
        f"doc_id {kind.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), prompts=True)
