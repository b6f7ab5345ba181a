"""Files of token ids under one canonical Huffman code of bounded length, and their reading.

A file set is a folder of three tables: ``codes`` (id, length) gives the canonical code; ``blocks`` holds whole documents each, their ids
as one run of bits with the bit offset of every ``STEP``-th id, so that blocks, and stretches of them, are decoded on
their own; ``parts`` says how many ids stand before each part of the blocks. Parts, blocks and documents ascend by doc_id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from verdigrid.llm import vocab
from verdigrid.llm.common import written
from verdigrid.session import scratch_path

#: Longest code in bits; ids between two checkpoints; ids after which a block is closed at the end of a document.
LONGEST, STEP, BLOCK = 20, 128, 1 << 17

BLOCKS = "part int, first bigint, doc_id array<bigint>, n_tokens array<bigint>, crc bigint, bits binary, checkpoints array<bigint>"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of the code of every id, 0 for ids without count: the least total under the bound, by merging packages."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids don't fit codes of {longest} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights, packages, levels = counts[order], np.empty(0, np.int64), []
    for _ in range(longest):
        items = np.concatenate([weights, packages])
        by_weight = np.argsort(items, kind="stable")
        levels.append(by_weight < len(order))
        items = items[by_weight]
        packages = items[:len(items) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(order) - 2
    for single in reversed(levels):
        n = int(single[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


class Code:
    """The canonical code of given lengths: shorter codes first, then smaller ids; one table look-up decodes an id."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.longest = max(1, int(self.lengths.max(initial=0)))
        if self.longest > 24:
            raise ValueError("codes of more than 24 bits")
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        room = 1 << (self.longest - self.lengths[ids])  # of all words of the greatest length, those that begin with the code
        first = np.cumsum(room) - room
        if room.sum() > 1 << self.longest:
            raise ValueError("lengths of no prefix code")
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[ids] = first >> (self.longest - self.lengths[ids])
        free = (1 << self.longest) - int(room.sum())
        self.id_of = np.concatenate([np.repeat(ids, room), np.zeros(free, np.int64)]).astype(np.uint32)
        self.step_of = np.concatenate([np.repeat(self.lengths[ids], room), np.ones(free, np.int64)]).astype(np.uint8)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of every ``STEP``-th id)."""
        if not len(ids):
            return b"", np.empty(0, np.int64)
        n_bits = self.lengths[ids]
        if not n_bits.all():
            raise ValueError("an id without code")
        end = np.cumsum(n_bits)
        begin = end - n_bits
        # each code lies in one or two words of 32 bits, and in every word some code begins
        word = begin >> 5
        value = self.codes[ids].astype(np.uint64) << (64 - n_bits - (begin & 31)).astype(np.uint64)
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        out[:-1] = np.add.reduceat(value >> np.uint64(32), firsts)
        out[1:] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), firsts)
        return out.astype(">u4").tobytes()[:(int(end[-1]) + 7) // 8], begin[::STEP]

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids from the first checkpoint on; all checkpoints advance together, an id at a time."""
        raw = np.frombuffer(bits + b"\0" * 4, np.uint8).astype(np.uint32)
        words = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = np.array(checkpoints, np.int64), 8 * len(words) - 1
        found = np.empty((min(n, STEP), len(at)), np.uint32)
        down = np.uint32(32 - self.longest)
        for word in found:
            np.right_shift(words[at >> 3] << (at & 7).astype(np.uint32), down, out=word)
            at += self.step_of[word]
            np.minimum(at, last, out=at)  # the last stretch may be shorter, and runs on for nothing
        return self.id_of[found.T.ravel()[:n]]


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, crc, row, ids) of every row, ids in 2 bytes each if the vocabulary allows, else 4; ``row`` tells rows apart."""
    raw = vocab.shipped(docs.sparkSession, tokenizer)
    kind = StructType.fromDDL("doc_id bigint, crc bigint, row bigint, ids binary")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = vocab.byte_level(raw.value)
        width = "<u2" if max(code.max_token_value, end_id) < 1 << 16 else "<u4"
        row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.array([*code.encode(t or "", allowed_special="all"), end_id], width).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(list(map(zlib.crc32, ids)), pa.int64()),
                                                  pa.array(range(row, row + len(ids)), pa.int64()), pa.array(ids, pa.binary())], schema=arrow)
                row += len(ids)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, kind)


def id_counts(tokens: DataFrame, width: str) -> DataFrame:
    """(id, n) over all rows: counted within each task first, at most one row for each task and id of the vocabulary."""
    kind = StructType.fromDDL("id int, n bigint")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), width), minlength=len(counts))
            seen[:len(counts)] += counts
            counts = seen
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], schema=arrow)

    return tokens.select("ids").mapInArrow(run, kind).groupBy("id").agg(F.sum("n").alias("n"))


def _blocks(ordered: DataFrame, lengths: np.ndarray, width: str) -> DataFrame:
    kind = StructType.fromDDL(BLOCKS)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(lengths), TaskContext.get().partitionId()
        docs, sizes, held, first, open_ids = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), width)
            bits, checkpoints = code.encode(ids)
            cols = [part, first, list(docs), list(sizes), zlib.crc32(ids.astype("<u4").tobytes()), bits, checkpoints.tolist()]
            return pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(arrow, cols)}, schema=arrow)

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(doc)
                sizes.append(len(raw) // int(width[-1]))
                held.append(raw)
                open_ids += sizes[-1]
                if open_ids >= BLOCK:
                    yield closed()
                    docs, sizes, held, first, open_ids = [], [], [], first + open_ids, 0
        if docs:
            yield closed()

    return ordered.mapInArrow(run, kind)


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int, longest: int = LONGEST) -> None:
    """Write the ids of all ``docs`` (doc_id, text), each followed by ``end_id``, as a file set in the new folder ``path``.

    Ids are those of ``tokenizer`` (a byte-level BPE file of the tokenizers library) without added special tokens; a null text is empty. Documents
    ascend by doc_id, null ids first; of rows with one id those whose ids have the smaller checksum come first. Other
    columns are ignored; no rows give files without blocks.

    Texts are encoded once, into the shared folder. Counts are summed in each task, then over tasks: no more rows than the
    vocabulary has come to the driver, which makes the code. The range partitioning orders by id, checksum and row, so that neither
    a repeated nor a null id gathers rows in one task.
    """
    spark = docs.sparkSession
    most = max(vocab.byte_level(vocab.shipped(spark, tokenizer).value).max_token_value, end_id)
    width = "<u2" if most < 1 << 16 else "<u4"
    tokens = written(encoded(docs, tokenizer, end_id), "tokens", codec="zstd")
    counts = np.zeros(most + 1, np.int64)
    for r in id_counts(tokens, width).collect():
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, longest)
    table = pa.table({"id": np.flatnonzero(lengths).astype(np.int32), "length": lengths[lengths > 0].astype(np.int32)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/codes")
    order = ["doc_id", "crc", "row"]
    _blocks(tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids"), lengths, width).write.parquet(f"{path}/blocks")
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda s, n: s + n)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).write.parquet(f"{path}/parts")


def _placed(spark: SparkSession, path: str) -> tuple[np.ndarray, DataFrame]:
    """The code lengths of a file set, and its blocks with the number of ids before each."""
    codes = spark.read.schema("id int, length int").parquet(f"{path}/codes").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["id"] for r in codes), default=0) + 1, np.uint8)
    for r in codes:
        lengths[r["id"]] = r["length"]
    parts = spark.read.schema("part int, before bigint").parquet(f"{path}/parts")
    return lengths, spark.read.schema(BLOCKS).parquet(f"{path}/blocks").join(parts, "part").withColumn("first", F.col("first") + F.col("before"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents of a file set: ``start`` counts the ids of all before, ``ids`` are little-endian in 4 bytes.

    Blocks are decoded on their own, wherever they are read. A block whose ids fail its checksum is an error.
    """
    lengths, blocks = _placed(spark, path)
    kind = StructType.fromDDL(DOCUMENTS)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for r in range(batch.num_rows):
                first, docs, sizes, crc, bits, checkpoints = [batch.column(c)[r].as_py() for c in ("first", "doc_id", "n_tokens", "crc", "bits", "checkpoints")]
                raw = code.decode(bits, checkpoints, sum(sizes)).astype("<u4", copy=False).tobytes()
                if zlib.crc32(raw) != crc:
                    raise ValueError(f"checksum of the block at id {first} differs")
                upto = np.cumsum(sizes)
                ids = [raw[4 * (b - n):4 * b] for b, n in zip(upto.tolist(), sizes)]
                yield pa.RecordBatch.from_pydict({"doc_id": docs, "start": first + upto - sizes, "n_tokens": sizes, "ids": ids}, schema=arrow)

    return blocks.select("first", "doc_id", "n_tokens", "crc", "bits", "checkpoints").mapInArrow(run, kind)


def read_token_range(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """(start, ids) of the stretches that make up ids ``start`` up to ``start + length`` of the whole file set, one for each block they lie in.

    Only blocks that hold some are read, and within a block only stretches between checkpoints that do.
    """
    lengths, blocks = _placed(spark, path)
    size = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda s, n: s + n)
    wanted = blocks.withColumn("n", size).filter((F.col("first") < start + length) & (F.col("first") + F.col("n") > start))
    kind = StructType.fromDDL("start bigint, ids binary")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for r in range(batch.num_rows):
                first, n, bits, checkpoints = [batch.column(c)[r].as_py() for c in ("first", "n", "bits", "checkpoints")]
                low, high = max(start - first, 0), min(start + length - first, n)
                from_, to = low // STEP, -(-high // STEP)
                ids = code.decode(bits, checkpoints[from_:to], min(n, to * STEP) - from_ * STEP)[low - from_ * STEP:high - from_ * STEP]
                yield pa.RecordBatch.from_pydict({"start": [first + low], "ids": [ids.astype("<u4").tobytes()]}, schema=arrow)

    return wanted.select("first", "n", "bits", "checkpoints").mapInArrow(run, kind)


def reread(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """What ``read_token_files`` gives of ``docs``, written to a folder of its own in the shared folder."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(docs.sparkSession, path)
