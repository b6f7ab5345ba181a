"""Alignment of two tokenizers on the same texts: offsets where tokens of both end cut them into groups, and ids in one group are linked."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from verdigrid.llm import vocab
from verdigrid.llm.common import written

#: Tokens of both sides after which a chunk of documents is closed; pairs that are expanded at a time.
CHUNK, BLOCK = 1_000_000, 1_000_000
#: Bits of an id within a pair's code.
BITS = 20


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of both sides up to every byte offset where tokens of both end, in order.

    Ends ascend. B's are entered in a dictionary by offset, an array with a place for each; A's that are found there are the cuts.
    """
    ends_a, ends_b = [np.asarray(ends, np.int64) for ends in (ends_a, ends_b)]
    index_b = np.zeros(max(ends_a.max(initial=0), ends_b.max(initial=0)) + 1, np.int32)
    index_b[ends_b] = np.arange(1, len(ends_b) + 1)
    found = index_b[ends_a]
    common = np.flatnonzero(found)
    return common + 1, found[common].astype(np.int64)


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the sum of its times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[firsts], np.add.reduceat(times[order], firsts) if len(keys) else times


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with how often it stands there; ``keys`` is sorted in place."""
    keys.sort()
    firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[firsts], np.diff(np.append(firsts, len(keys)))


def thin(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, compressed: Spark's own codecs leave ids as long as they are."""
    return zstandard.compress(values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")).tobytes(), 3)


def wide(packed: bytes, count: int) -> np.ndarray:
    raw = zstandard.decompress(packed)
    return np.frombuffer(raw, f"<u{len(raw) // count}").astype(np.int64) if count else np.empty(0, np.int64)


class Chunk:
    """Tokens and groups of some documents, as flat arrays. ``of`` has each group's document."""

    def __init__(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, of: np.ndarray) -> None:
        self.a, self.b, self.size_a, self.size_b, self.of = a, b, size_a, size_b, of

    @staticmethod
    def _distinct(ids: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``groups``, id, times) of the distinct ids of these groups."""
        starts = (np.cumsum(sizes) - sizes)[groups]
        n = sizes[groups]
        place = np.repeat(np.arange(len(groups)), n)
        at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n - starts, n)
        keys, times = counted(place << BITS | ids[at])
        return keys >> BITS, keys & ((1 << BITS) - 1), times

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (document and code of the pair, links) for the pairs of ids within a group, in order.

        Groups of one token each side link as they are; others are expanded by their distinct ids, and in blocks.
        """
        single = (self.size_a == 1) & (self.size_b == 1)
        ends_a, ends_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        yield counted(self.of[single] << 2 * BITS | self.a[ends_a[single] - 1] << BITS | self.b[ends_b[single] - 1])
        groups = np.flatnonzero(~single)
        group_a, a, times_a = self._distinct(self.a, self.size_a, groups)
        group_b, b, times_b = self._distinct(self.b, self.size_b, groups)
        first_b = np.searchsorted(group_b, np.arange(len(groups) + 1))
        partners = np.diff(first_b)[group_a]
        upto = np.cumsum(partners)
        at = 0
        while at < len(a):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, "right")))
            n = partners[at:end]
            row = np.repeat(np.arange(at, end), n)
            other = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first_b[group_a[row]]
            yield summed(self.of[groups[group_a[row]]] << 2 * BITS | a[row] << BITS | b[other], times_a[row] * times_b[other])
            at = end

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, code, links) of every document's distinct pairs, in order."""
        keys, times = summed(*map(np.concatenate, zip(*self.links())))
        return keys >> 2 * BITS, keys & ((1 << 2 * BITS) - 1), times


class Aligner:
    """Both tokenizers with the bytes of their ids, and the texts of the groups' digests."""

    def __init__(self, raw_a: bytes, raw_b: bytes) -> None:
        self.code_a = vocab.byte_level(raw_a)
        self.bytes_a = vocab.byte_level_bytes(self.code_a)
        self.code_b, self.bytes_b = vocab.pieces(raw_b)
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << BITS:
            raise ValueError(f"ids of more than {BITS} bits")
        self.len_a, self.len_b = [np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b)]
        # an id inside a group, an id that ends it, for either side
        self.parts = [str(i) + mark for ids, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for mark in marks for i in range(len(ids))]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both; none for an empty text or one that either side does not give back byte by byte."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        raw = (" " + text).encode()
        a = self.code_a.encode_to_numpy(" " + text, disallowed_special=())
        b = self.code_b.encode(text)
        if self.code_a.decode_bytes(a) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return none, none
        return a.astype(np.int64), np.array(b, np.int64)

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return cuts(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))

    def written_groups(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> str:
        """``a1,a2|b1;...`` with ids of one side between commas, sides parted by ``|`` and groups by ``;``."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        code_a, code_b = a.copy(), b + 2 * n_a
        code_a[cuts_a - 1] += n_a
        code_b[cuts_b - 1] += n_b
        out = np.empty(len(a) + len(b), np.int64)
        # before a token of A stand the B tokens of earlier groups, before one of B the A tokens of its group too
        out[np.arange(len(a)) + np.repeat(np.append(0, cuts_b[:-1]), np.diff(cuts_a, prepend=0))] = code_a
        out[np.arange(len(b)) + np.repeat(cuts_a, np.diff(cuts_b, prepend=0))] = code_b
        return "".join(map(self.parts.__getitem__, out.tolist()))[:-1]


def _aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, chunk: int) -> DataFrame:
    """One row for each chunk: its documents' digests, the chunk's distinct pairs with their documents, and each document's pairs.

    Of a document's pairs the places among the chunk's pairs are kept, as steps from one to the next, and the links.
    """
    spark = docs.sparkSession
    raw_a, raw_b = vocab.shipped(spark, tokenizer_a), vocab.shipped(spark, tokenizer_b)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    kind = StructType.fromDDL(f"chunk bigint, doc_id array<{id_kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, groups_sha256 array<string>, "
                              "n_pairs array<bigint>, steps binary, links binary, codes binary, held binary")
    arrow = to_arrow_schema(kind)

    def row(number: int, ids: list, found: list[tuple]) -> pa.RecordBatch:
        a, b, cuts_a, cuts_b, shas = zip(*found)
        n_groups = list(map(len, cuts_a))
        sizes = [np.concatenate([np.diff(c, prepend=0) for c in side]) for side in (cuts_a, cuts_b)]
        doc, code, links = Chunk(np.concatenate(a), np.concatenate(b), *sizes, np.repeat(np.arange(len(ids)), n_groups)).pairs()
        codes, held = counted(code.copy())
        place = np.searchsorted(codes, code)
        firsts = np.append(True, doc[1:] != doc[:-1])[:len(doc)]
        cols = {"chunk": number, "doc_id": ids, "n_a": list(map(len, a)), "n_b": list(map(len, b)), "n_groups": n_groups, "groups_sha256": list(shas),
                "n_pairs": np.bincount(doc, minlength=len(ids)).tolist(), "steps": thin(np.where(firsts, place, np.diff(place, prepend=0))), "links": thin(links),
                "codes": codes.astype("<i8").tobytes(), "held": held.astype("<i8").tobytes()}
        return pa.RecordBatch.from_pydict({k: [v] for k, v in cols.items()}, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner(raw_a.value, raw_b.value)
        number, ids, found, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                a, b = both.tokens(text.as_py())
                cuts_a, cuts_b = both.cuts(a, b)
                sha = hashlib.sha256(both.written_groups(a, b, cuts_a, cuts_b).encode()).hexdigest() if len(a) else ""
                ids.append(doc)
                found.append((a, b, cuts_a, cuts_b, sha))
                size += len(a) + len(b) + 1
                if size >= chunk:
                    yield row(number, ids, found)
                    number, ids, found, size = number + 1, [], [], 0
        if ids:
            yield row(number, ids, found)

    return docs.select("doc_id", "text").mapInArrow(run, kind)


def _exploded(chunks: DataFrame) -> DataFrame:
    """(chunk, code, n) of every chunk's distinct pairs."""
    kind = StructType.fromDDL("chunk bigint, code bigint, n bigint")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, codes, held in zip(*[batch.column(c).to_pylist() for c in ("chunk", "codes", "held")]):
                codes = np.frombuffer(codes, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), chunk, np.int64)), pa.array(codes),
                                                  pa.array(np.frombuffer(held, "<i8"))], schema=arrow)

    return chunks.select("chunk", "codes", "held").mapInArrow(run, kind)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(code, n, best): documents that hold a pair of linked ids, and the most that any pair of its A id has."""
    counts = written(_exploded(chunks).groupBy("code").agg(F.sum("n").alias("n")), "pair_counts")
    a = F.shiftright("code", BITS).alias("a")
    best = counts.groupBy(a).agg(F.max("n").alias("best"))
    return counts.withColumn("a", a).join(best, "a").select("code", "n", "best")


def align_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text of ``docs`` (doc_id, text).

    A is a byte-level BPE file, B a piece model that adds a space; A encodes the text behind a space, special tokens are plain text.
    Byte offsets where tokens of both end cut them into groups. Every A and B token of a group are linked; a pair of ids counts
    the rows of ``docs`` that hold it linked. ``n_best`` are links whose count is the highest of their A id, ``count_sum``
    adds the counts of all links. A text that is null, empty or not given back byte by byte has zeros and ''.
    Rows count each, also repeated ones and those with a null doc_id; other columns are ignored; no rows give no rows.

    Documents are encoded once, in chunks of about ``chunk`` tokens, whose distinct pairs are summed over the corpus. The counts
    a chunk asks for come back to it by a join: a pair takes part once for each chunk however many links it has, so frequent
    pairs are no hot keys, and no table of all pairs is sent anywhere.
    """
    chunks = written(_aligned(docs, tokenizer_a, tokenizer_b, chunk), "aligned")
    asked = _exploded(chunks).select("chunk", "code").join(pair_counts(chunks), "code")
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    kind = StructType.fromDDL(f"doc_id {id_kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    arrow = to_arrow_schema(kind)

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = {c: left.column(c)[0].as_py() for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
        n_pairs = np.array(left.column("n_pairs")[0].as_py(), np.int64)
        steps, links = [wide(left.column(c)[0].as_py(), int(n_pairs.sum())) for c in ("steps", "links")]
        order = np.argsort(right.column("code").to_numpy())  # as in the chunk
        n, best = [right.column(c).to_numpy()[order] for c in ("n", "best")]
        doc = np.repeat(np.arange(len(n_pairs)), n_pairs)
        upto = np.cumsum(steps)
        place = upto - np.repeat(np.append(0, upto)[np.cumsum(n_pairs) - n_pairs], n_pairs)
        sums = np.zeros((3, len(n_pairs)), np.int64)
        for total, part in zip(sums, (links, links * (n[place] == best[place]), links * n[place])):
            np.add.at(total, doc, part)
        return pa.table({**lists, **dict(zip(("n_links", "n_best", "count_sum"), sums))}).select(arrow.names).cast(arrow)

    texts = chunks.drop("codes", "held").groupBy("chunk")
    return texts.cogroup(asked.groupBy("chunk")).applyInArrow(looked_up, kind)
