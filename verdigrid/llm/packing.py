"""Packing token sequences with bounded space: a fixed number of open windows a task, best fit, leftovers merged last."""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from verdigrid.llm.common import written

WIDTH = 1024
#: Windows that one task keeps open.
OPEN_WINDOWS = 64
#: A piece is cut to fill a window that is about to be emitted if that saves at least so many places.
LEAST_CUT = 4
#: Tasks whose last windows one task merges.
MERGE = 64

PIECE = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, open boolean"
Piece = tuple  # (doc_id, start, ids as bytes, tokens of its document)


class Windows:
    """Open windows ordered by free places. ``done`` gets (piece, sequence, offset) of every emitted window."""

    def __init__(self, first_id: int, width: int = WIDTH, most: int = OPEN_WINDOWS) -> None:
        self.width, self.most, self.next_id = width, most, first_id
        self.free: list[tuple[int, int]] = []
        self.held: dict[int, list[Piece]] = {}
        self.done: list[tuple[Piece, int, int]] = []

    def emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((piece, self.next_id, offset))
            offset += len(piece[2]) // 4
        self.next_id += 1

    def _put(self, at: int, piece: Piece) -> None:
        gap, key = self.free.pop(at)
        self.held[key].append(piece)
        gap -= len(piece[2]) // 4
        if gap:
            insort(self.free, (gap, key))
        else:
            self.emit(self.held.pop(key))

    def add(self, piece: Piece) -> None:
        """Place a piece in the fullest window that takes it whole; else open one; else emit the fullest, filled by a cut."""
        doc, start, ids, total = piece
        while len(ids) >= 4 * self.width:  # the document's full windows need no place
            self.emit([(doc, start, ids[:4 * self.width], total)])
            start, ids = start + self.width, ids[4 * self.width:]
        while ids:
            n = len(ids) // 4
            at = bisect_left(self.free, (n, -1))
            if at < len(self.free):
                self._put(at, (doc, start, ids, total))
                return
            if len(self.free) < self.most:
                key = max(self.held, default=-1) + 1
                self.held[key] = [(doc, start, ids, total)]
                insort(self.free, (self.width - n, key))
                return
            gap, key = self.free[0]
            if gap >= LEAST_CUT:
                self._put(0, (doc, start, ids[:4 * gap], total))
                start, ids = start + gap, ids[4 * gap:]
            else:
                self.free.pop(0)
                self.emit(self.held.pop(key))

    def rest(self) -> list[Piece]:
        """Run the open windows together with cuts; returns the pieces of the last one, shorter than a window."""
        pieces = [p for _, key in self.free for p in self.held[key]]
        self.free, self.held = [], {}
        row: list[Piece] = []
        room = self.width
        for doc, start, ids, total in pieces:
            while ids:
                take = min(room, len(ids) // 4)
                row.append((doc, start, ids[:4 * take], total))
                start, ids, room = start + take, ids[4 * take:], room - take
                if not room:
                    self.emit(row)
                    row, room = [], self.width
        return row

    def close(self, row: list[Piece]) -> None:
        """Emit the very last pieces as windows of powers of two, which need no padding."""
        left = sum(len(p[2]) // 4 for p in row)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            out = []
            while room:
                doc, start, ids, total = row.pop(0)
                take = min(room, len(ids) // 4)
                out.append((doc, start, ids[:4 * take], total))
                if len(ids) > 4 * take:
                    row.insert(0, (doc, start + take, ids[4 * take:], total))
                room -= take
            self.emit(out)


def _rows(done: list, kind: pa.Schema, still_open: bool) -> pa.RecordBatch:
    cols = {"doc_id": [p[0] for p, _, _ in done], "start": [p[1] for p, _, _ in done], "length": [len(p[2]) // 4 for p, _, _ in done],
            "ids": [p[2] for p, _, _ in done], "doc_tokens": [p[3] for p, _, _ in done], "sequence_id": [s for _, s, _ in done],
            "offset": [o for _, _, o in done], "open": [still_open] * len(done)}
    return pa.RecordBatch.from_pydict(cols, schema=kind)


def _first_id(level: int) -> int:
    """Sequence ids: the level of merging, the task and a counter; a task that runs again gives the same ids."""
    return (level << 56) | (TaskContext.get().partitionId() << 32)


def encoder(tokenizer: str):
    """A byte-level BPE file of the tokenizers library as an encoder of the tiktoken library, which gives the same ids several times faster.

    The file's vocabulary gives the ranks; its special tokens are recognised in texts as the tokenizers library does.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(tokenizer, encoding="utf-8") as f:
        kept = json.load(f)
    if kept["model"]["type"] != "BPE" or kept["pre_tokenizer"]["type"] != "ByteLevel" or kept["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError(f"{tokenizer} is no byte-level BPE without a prefix space")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in kept["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in kept["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, width: int = WIDTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Each document is its ids by ``tokenizer`` (a file of the tokenizers library), without special tokens, and ``end_id``;
    a null text is empty. ``ids`` holds little-endian unsigned 32-bit ids. Each id is in exactly one piece. Rows are packed
    on their own, also repeated ones and those with a null doc_id; other columns are ignored; no rows give no rows.

    One pass without a shuffle packs what each task reads and writes it to the shared folder. Each task leaves less than
    one window, and these are merged ``MERGE`` tasks at a time until one is left.
    """
    arrow = to_arrow_schema(StructType.fromDDL(PIECE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        windows = Windows(_first_id(0), width, open_windows)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at in range(0, len(ids), 256):
                for doc, text in zip(ids[at:at + 256], texts[at:at + 256]):
                    raw = array("I", encode(text or "", allowed_special="all")).tobytes() + end  # little-endian where Spark runs
                    windows.add((doc, 0, raw, len(raw) // 4))
                yield _rows(windows.done, arrow, False)
                windows.done = []
        row = windows.rest()
        yield _rows(windows.done, arrow, False)
        yield _rows([(p, windows.next_id, 0) for p in row], arrow, True)

    level, pieces = 0, written(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, StructType.fromDDL(PIECE)), "packed")
    done = [pieces.filter(~F.col("open"))]
    while True:
        last = pieces.filter("open")
        groups = last.select("sequence_id").distinct().count()
        if not groups:
            break
        level += 1
        pieces = written(_merged(last, -(-groups // MERGE), level, width, open_windows), "packed")
        done.append(pieces.filter(~F.col("open")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open")


def _merged(last: DataFrame, tasks: int, level: int, width: int, open_windows: int) -> DataFrame:
    """Run together what up to ``MERGE`` tasks left, less than one window each; a single task closes the packing."""
    arrow = to_arrow_schema(StructType.fromDDL(PIECE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(_first_id(level), width, open_windows)
        for batch in batches:
            for r in batch.to_pylist():
                windows.add((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
        row = windows.rest()
        if tasks == 1:
            windows.close(row)
            row = []
        yield _rows(windows.done, arrow, False)
        yield _rows([(p, windows.next_id, 0) for p in row], arrow, True)

    # few rows: the pieces of less than one window for each of MERGE tasks
    placed = last.repartition(tasks, F.xxhash64("sequence_id")).sortWithinPartitions("sequence_id", "doc_id", "start", "ids")
    return placed.coalesce(tasks).mapInArrow(run, StructType.fromDDL(PIECE))
