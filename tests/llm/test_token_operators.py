"""Periodic runs, tokenizer alignment and token files against brute force and the named libraries, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verdigrid.llm import alignment, packing, periodic_runs, queries, token_files, vocab

from .test_operators import DOCS, WORD, empty, odd_documents

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11: periodic runs

def plain_runs(words):
    """Stretches of each period, kept if they fit and have no smaller period."""
    code = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    n, out = len(ids), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            smaller = any((ids[start + p:end] == ids[start:end - p]).all() for p in range(1, q)) if end - start >= max(6, 4 * q) else True
            if not smaller:
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), s, n, q, n and n * 1000 // q, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def planted(doc, text):
    words = WORD.findall(text or "")
    if doc is None:
        return words
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_runs_equal_brute_force(ids):
    assert list(map(tuple, periodic_runs.runs_of(np.array(ids, np.int64)).tolist())) == plain_runs(ids)


def test_runs_of_repeated_blocks():
    rng = random.Random(5)
    for _ in range(300):
        ids = []
        while len(ids) < 90:
            block = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 12))]
            ids += (block * rng.randrange(1, 9))[rng.randrange(3):]
        assert list(map(tuple, periodic_runs.runs_of(np.array(ids)).tolist())) == plain_runs(ids)


def test_runs_of_long_texts():
    ids = np.arange(200_000)
    ids[50_000:150_000] = 7 + np.arange(100_000) % 20_011
    assert periodic_runs.runs_of(ids).tolist() == [[50_000, 100_000, 20_011]]
    assert periodic_runs.runs_of(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(None, exponent=3)


def test_runs_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, sf).collect()}
    assert got == {r.doc_id: plain_row(planted(r.doc_id, r.text)) for r in docs}
    assert sum(r[0] > 0 for r in got.values()) > 5


def test_runs_on_odd_rows(spark):
    odd = odd_documents(spark, [(40, "a b " * 30), (41, "x " * 5), (42, "x " * 6)])
    plain = {r.doc_id: r for r in periodic_runs.periodic_runs(odd).collect()}
    assert [tuple(plain[i].runs) for i in (1, 2, 3, 41)] == [()] * 4 and plain[1].collapsed == plain[3].collapsed == ""
    assert [tuple(r) for r in plain[40].runs] == [(0, 60, 2)] and plain[40].collapsed == "a b" and plain[42].collapsed == "x"
    rows = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(odd))).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr((r.doc_id, *plain_row(planted(r.doc_id, r.text)))) for r in odd.collect())
    assert periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(empty(spark)))).count() == 0


# 12: alignment

def plain_alignment(rows):
    """All result rows, by the libraries themselves and by loops over all pairs of tokens."""
    side_a, side_b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    side_a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def bytes_b(i):
        p = side_b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    out = []
    for doc, text in rows:
        groups = []
        if text:
            raw = (" " + text).encode()
            ids = side_a.encode(" " + text, add_special_tokens=False).ids, side_b.encode(text)
            ends = []
            for tokens, of in zip(ids, (lambda i: bytes(byte_of[c] for c in side_a.id_to_token(i)), bytes_b)):
                at, spans = 0, []
                for i in tokens:
                    spans.append((at, at := at + len(of(i)), i))
                ends.append(spans if b"".join(of(i) for i in tokens) == raw else None)
            if all(ends):
                queues = [side[::-1] for side in ends]
                for high in sorted({e for _, e, _ in ends[0]} & {e for _, e, _ in ends[1]}):
                    groups.append([])
                    for queue in queues:
                        groups[-1].append([])
                        while queue and queue[-1][1] <= high:
                            groups[-1][-1].append(queue.pop()[2])
        out.append((doc, groups))
    held = Counter(p for _, groups in out for p in {(a, b) for x, y in groups for a in x for b in y})
    best = Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    result = []
    for doc, groups in out:  # links of one text at a time
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        result.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                       sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha(text) if groups else ""))
    return result


def test_cuts():
    assert [x.tolist() for x in alignment.cuts([1, 3, 6], [3, 4, 6])] == [[2, 3], [1, 3]]
    assert [x.tolist() for x in alignment.cuts([], [])] == [[], []]


def test_cuts_are_those_of_sets_and_need_no_python_numbers():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = [np.flatnonzero(rng.random(300) < p) + 1 for p in (0.4, 0.2)]
        common = sorted(set(a.tolist()) & set(b.tolist()))
        got = alignment.cuts(a, b)
        assert [x.tolist() for x in got] == [[a.tolist().index(c) + 1 for c in common], [b.tolist().index(c) + 1 for c in common]]
        assert all(x.dtype == np.int64 for x in got)


def test_alignment_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40).cache()
    want = sorted(plain_alignment([(r.doc_id, r.text) for r in docs.collect()]))
    for chunk in (alignment.CHUNK, 2000):
        assert sorted(map(tuple, alignment.align_documents(docs, BYTE_BPE, PIECES, chunk).collect())) == want


def test_alignment_in_small_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    size_a, size_b = rng.integers(1, 40, 30), rng.integers(1, 40, 30)
    one = alignment.Chunk(rng.integers(0, 9, size_a.sum()), rng.integers(0, 9, size_b.sum()), size_a, size_b, np.sort(rng.integers(0, 5, 30)))
    want = Counter()
    for doc, a, b in zip(one.of, np.split(one.a, np.cumsum(size_a)), np.split(one.b, np.cumsum(size_b))):
        want.update((int(doc), int(x) << alignment.BITS | int(y)) for x in a for y in b)
    for block in (alignment.BLOCK, 7):
        monkeypatch.setattr(alignment, "BLOCK", block)
        assert {(d, c): n for d, c, n in zip(*map(np.ndarray.tolist, one.pairs()))} == want


def test_alignment_query(spark, sf):
    out = queries.op12_tokenizer_alignment(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    want = sorted(plain_alignment([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]))
    assert sorted(map(tuple, out)) == want


def test_alignment_on_odd_rows(spark):
    extra = [(50, "a▁b"), (51, "<|endoftext|> and </s> and <0x41>"), (52, "漢字かな交じり文 🙂🙂" * 20), (53, "  two  spaces\n\n\tand tab "), (54, "aaaaaaaaaaa" * 300)]
    odd = odd_documents(spark, extra)
    rows = alignment.align_documents(odd, BYTE_BPE, PIECES, 5000).collect()
    want = plain_alignment([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    zeros = {r.doc_id for r in rows if not r.n_a}
    assert {1, 2, 50} <= zeros and not {4, 51, 52, 53, 54} & zeros
    assert alignment.align_documents(empty(spark), BYTE_BPE, PIECES).count() == 0


# 13: token files

def best_total(counts, longest):
    """Least total of all code lengths under the bound for which a prefix code exists."""
    fits = (x for x in product(range(1, longest + 1), repeat=len(counts)) if sum(2.0 ** -i for i in x) <= 1)
    return min(sum(n * k for n, k in zip(counts, x)) for x in fits)


def test_code_lengths_are_the_best():
    rng = random.Random(1)
    for _ in range(60):
        counts = np.array([rng.choice([1, 2, 3, 10, 100, 5000]) for _ in range(rng.randrange(2, 7))])
        for longest in (3, 4):
            lengths = token_files.code_lengths(counts, longest)
            assert lengths.max() <= longest and int((lengths * counts).sum()) == best_total(counts, longest)
    assert token_files.code_lengths(np.array([0, 9, 0])).tolist() == [0, 1, 0]
    assert token_files.code_lengths(np.zeros(4, int)).tolist() == [0] * 4
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9, int), 3)
    with pytest.raises(ValueError):
        token_files.Code(np.array([1, 1, 1]))


def test_code_is_canonical():
    code = token_files.Code(np.array([2, 0, 1, 3, 3]))
    assert code.codes.tolist() == [0b10, 0, 0b0, 0b110, 0b111]


def test_round_trip():
    rng = np.random.default_rng(4)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.minimum(rng.geometric(0.002, n), 49_000)
        code = token_files.Code(token_files.code_lengths(np.bincount(ids, minlength=50_000) + (np.arange(50_000) % 7 == 0), 17))
        bits, checkpoints = code.encode(ids)
        assert len(checkpoints) == -(-n // token_files.STEP)
        if n:
            assert len(bits) == -(-int(code.lengths[ids].sum()) // 8) and (code.decode(bits, checkpoints, n) == ids).all()
        if n > 600:
            assert (code.decode(bits, checkpoints[1:3], 2 * token_files.STEP) == ids[token_files.STEP:3 * token_files.STEP]).all()
    with pytest.raises(ValueError):
        token_files.Code(np.array([1, 0, 1])).encode(np.array([1]))


def plain_files(rows, end_id):
    library = Tokenizer.from_file(BYTE_BPE)
    out = []
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.append((doc, len(ids), zlib.crc32(ids.tobytes()), ids))
    out.sort(key=lambda r: (r[0] is not None, r[0], zlib.crc32(r[3].astype("<u2").tobytes())))
    return out


def test_files_query(spark, sf):
    want, start = [], 0
    rows = plain_files([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 2)
    for doc, n, crc, _ in rows:
        want.append((doc, start, n, crc))
        start += n
    assert sorted(map(tuple, queries.op13_token_files(spark, sf).collect())) == sorted(want)


def test_files_on_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 700)
    odd = odd_documents(spark, [(51, "<|endoftext|> is special"), *[(None, "many of no id")] * 40, *[(60, f"text {i}") for i in range(40)]])
    path = str(tmp_path / "files")
    token_files.write_token_files(odd, BYTE_BPE, path, end_id=50_256)
    rows = plain_files([(r.doc_id, r.text) for r in odd.collect()], 50_256)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in got] == [(d, n, ids.tobytes()) for d, n, _, ids in rows]
    assert [r.start for r in got] == np.cumsum([0, *[n for _, n, _, _ in rows[:-1]]]).tolist()
    stream = np.concatenate([r[3] for r in rows])
    for start, length in ((0, 5), (300, 900), (0, len(stream)), (len(stream) - 3, 100), (len(stream), 5)):
        pieces = sorted(token_files.read_token_range(spark, path, start, length).collect(), key=lambda r: r.start)
        found = np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces] or [np.empty(0, "<u4")])
        assert (found == stream[start:start + length]).all()
    assert spark.read.parquet(f"{path}/blocks").count() > 2


def test_broken_block(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame([(1, "some words of text")], "doc_id bigint, text string"), BYTE_BPE, path, end_id=2)
    broken = str(tmp_path / "broken")
    for table in ("codes", "parts"):
        spark.read.parquet(f"{path}/{table}").write.parquet(f"{broken}/{table}")
    spark.read.parquet(f"{path}/blocks").withColumn("crc", F.col("crc") + 1).write.parquet(f"{broken}/blocks")
    with pytest.raises(Exception, match="checksum"):
        token_files.read_token_files(spark, broken).collect()


def test_no_token_files(spark):
    assert token_files.reread(empty(spark), BYTE_BPE, 2).count() == 0


def test_foreign_vocabularies_are_refused():
    with pytest.raises(ValueError):
        vocab.byte_level(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
