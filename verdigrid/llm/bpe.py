"""Byte-level BPE with a rank queue kept as a hierarchy of bitmaps, and its decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from verdigrid.llm.common import map_batches

#: Encoded pre-tokens that one task remembers from batch to batch; bytes up to which many pre-tokens share one queue.
MEMORY, LONGEST = 400_000, 64
#: Bits a bitmap word has.
WORD = 64


#: What the classes of a splitting pattern hold of the first 256 characters, where the standard library splits faster.
LATIN = {r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": "\t-\r \x85\xa0"}


def latin(pattern: str) -> str:
    """The pattern for texts of the first 256 characters, with classes written out."""
    inside, out = False, ""
    for part in re.split(r"(\\p\{L\}|\\p\{N\}|\\[sS]|\[|\])", pattern):
        if part in LATIN:
            out += LATIN[part] if inside else f"[{LATIN[part]}]"
        elif part == r"\S" and not inside:
            out += f"[^{LATIN[chr(92) + 's']}]"
        else:
            inside = part == "[" or inside and part != "]"
            out += part
    return out


class RankQueue:
    """Buckets by merge rank, each a heap of list positions; levels of bitmaps find the lowest rank in use.

    A bit on a level says that the word below it is not zero.
    """

    def __init__(self, ranks: int) -> None:
        self.levels: list[list[int]] = []
        size = ranks
        while True:
            size = -(-size // WORD)
            self.levels.append([0] * size)
            if size == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        at = rank
        for words in self.levels:
            at, bit = divmod(at, WORD)
            before = words[at]
            words[at] = before | 1 << bit
            if before:
                break

    def lowest(self) -> int:
        """The lowest rank in use, -1 if there is none: one find-first-set a level."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if not word:
                return -1
            at = at * WORD + (word & -word).bit_length() - 1
        return at

    def take(self, rank: int) -> list[int]:
        """Remove and return a whole bucket."""
        at = rank
        for words in self.levels:
            at, bit = divmod(at, WORD)
            words[at] &= ~(1 << bit)
            if words[at]:
                break
        return self.buckets.pop(rank)

    def pop(self) -> tuple[int, int]:
        """The leftmost position of the lowest rank; (-1, -1) if there is none."""
        rank = self.lowest()
        if rank < 0:
            return -1, -1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self.take(rank)
        return rank, position


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Codec:
    """Encode and decode whole texts by the ranks of a vocabulary (``bytes -> rank``), as merges by lowest rank, leftmost first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.split = regex.compile(pattern)
        self.split_latin = re.compile(latin(pattern))
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.memory: dict[str, tuple[int, ...]] = {}
        # rank of every pair of ids that joins to a token, as sorted codes, and of every pair of bytes
        self.none = max(ranks.values()) + 1
        pairs = sorted((ranks[t[:i]] * (self.none + 1) + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.codes, self.code_ranks = (np.array(x, np.int64) for x in zip(*pairs, (1 << 62, -1)))
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. Work is proportional to its length, but for the order within a bucket."""
        ranks, queue, n = self.ranks, self.queue, len(piece)
        end = list(range(1, n + 1))  # where the part that begins here ends; parts are a linked list over positions
        before = list(range(-1, n))
        pair = [-1] * (n + 1)  # rank of the part here with the next one, -1 if none or gone: entries that differ are stale

        def look(i: int) -> None:
            j = end[i]
            rank = ranks.get(piece[i:end[j]], -1) if j < n else -1
            pair[i] = rank
            if rank >= 0:
                queue.push(rank, i)

        for i in range(n - 1):
            look(i)
        while True:
            rank, i = queue.pop()
            if rank < 0:
                break
            if pair[i] != rank:
                continue
            j = end[i]
            pair[j] = -1
            end[i] = end[j]
            if end[i] < n:
                before[end[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where they don't join."""
        codes = left * (self.none + 1) + right
        at = np.searchsorted(self.codes, codes)
        return np.where(self.codes[at] == codes, self.code_ranks[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of many short pre-tokens with one queue: a bucket is taken whole, and the leftmost position of each pre-token
        in it is merged at once; later ones of the same pre-token go back, as a lower rank may come up before them."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        n, ends = len(raw), sizes.cumsum()
        starts, piece_of = ends - sizes, np.repeat(np.arange(len(pieces)), sizes)
        ids = np.append(self.bytes[raw], self.none)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[starts] = n, n
        pair = np.append(self.joined(ids[:n], ids[after[:n]]), -1)
        live = np.ones(n, bool)
        queue = self.queue
        push, buckets = queue.push, queue.buckets

        def look(at: np.ndarray) -> None:
            found = self.joined(ids[at], ids[after[at]])
            pair[at] = found
            for rank, i in zip(found.tolist(), at.tolist()):
                if rank >= 0:
                    if rank in buckets:
                        buckets[rank].append(i)
                    else:
                        push(rank, i)

        first = np.flatnonzero(pair >= 0)
        first = first[np.argsort(pair[first], kind="stable")]
        if len(first):
            cuts = np.flatnonzero(np.diff(pair[first])) + 1
            for part in np.split(first, cuts):
                push(int(pair[part[0]]), 0)
                buckets[int(pair[part[0]])] = part.tolist()
        while (rank := queue.lowest()) >= 0:
            at = np.array(queue.take(rank))
            at = np.sort(at[pair[at] == rank])
            if not len(at):
                continue
            of = piece_of[at]
            again = np.append(False, of[1:] == of[:-1])
            if again.any():
                late = at[again]
                push(rank, 0)
                buckets[rank] = late.tolist()
                at = at[~again]
            gone = after[at]
            ids[at], pair[gone], live[gone] = rank, -1, False
            then = after[gone]
            after[at], before[then] = then, at
            back = before[at]
            look(np.concatenate([at, back[back < n]]))
        out, counts = ids[:n][live].tolist(), np.add.reduceat(live, starts).cumsum().tolist()
        return [tuple(out[a:b]) for a, b in zip([0, *counts], counts)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, every match of the pattern on its own; what is not remembered is merged together."""
        memory, ranks = self.memory, self.ranks
        if len(memory) > MEMORY:
            memory.clear()
        split = [(self.split_latin if is_latin(t) else self.split).findall(t) for t in texts]
        short = []
        for match in {m for found in split for m in found if m not in memory}:
            raw = match.encode("utf-8", "replace")
            whole = ranks.get(raw)
            if whole is not None:
                memory[match] = (whole,)
            elif len(raw) > LONGEST:
                memory[match] = tuple(self.merge(raw))
            else:
                short.append((match, raw))
        if short:
            memory.update(zip([m for m, _ in short], self.merge_all([r for _, r in short])))
        return [list(chain.from_iterable(map(memory.__getitem__, found))) for found in split]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, digests: bool = False) -> DataFrame:
    """(doc_id, ids) of every whole text; with ``digests``: doc_id, n_tokens, ids_sha256 and decoded_sha256 after decoding.

    ``ranks`` is a rank file, ``pattern`` splits texts before the merges. A null text is empty and has no ids. Rows are
    encoded each, also repeated ones and those with a null doc_id; other columns are ignored. One pass, no shuffle; a
    pre-token of any length is encoded whole.
    """
    kept: list[Codec] = []

    def run(batch: dict) -> dict:
        if not kept:
            kept.append(Codec.from_file(ranks, pattern))
        codec = kept[0]
        encoded = codec.encode_all([t or "" for t in batch["text"]])
        if not digests:
            return {"doc_id": batch["doc_id"], "ids": encoded}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return {"doc_id": batch["doc_id"], "n_tokens": list(map(len, encoded)), "ids_sha256": [sha(",".join(map(codec.names.__getitem__, x)).encode()) for x in encoded],
                "decoded_sha256": [sha(codec.decode(x)) for x in encoded]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, {more}", rows=2048)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, raw) from (doc_id, ids): the bytes of the encoded texts. Null ids give null, an empty list gives no bytes."""
    kept: list[Codec] = []

    def run(batch: dict) -> dict:
        if not kept:
            kept.append(Codec.from_file(ranks, pattern))
        return {"doc_id": batch["doc_id"], "raw": [None if x is None else kept[0].decode(x) for x in batch["ids"]]}

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, raw binary")
