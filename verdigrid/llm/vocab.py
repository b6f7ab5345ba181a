"""Vocabulary files of public tokenizers, read by the driver and sent to the tasks as bytes."""

from __future__ import annotations

import json
import re
from pathlib import Path

import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file, a few MB: executors need no copy at the driver's path."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def byte_level(raw: bytes) -> tiktoken.Encoding:
    """A byte-level BPE file of the tokenizers library as an encoding of the tiktoken library, which gives the same ids faster.

    This holds as merges come in the order of the ids they make and texts are not changed before; other files are refused.
    """
    kept = json.loads(raw)
    model, before = kept["model"], kept["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or before.get("add_prefix_space") or kept.get("normalizer"):
        raise ValueError("no byte-level BPE without normaliser and prefix space")
    made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("merges don't come in the order of their ids")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in kept["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def byte_level_bytes(encoding: tiktoken.Encoding) -> list[bytes]:
    """Bytes of every id up to the largest; none for ids that are not taken."""
    out = [b""] * (encoding.max_token_value + 1)
    for i, token in zip(encoding._mergeable_ranks.values(), encoding._mergeable_ranks):
        out[i] = token
    return out


def pieces(raw: bytes) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """A piece model and the bytes of every id: U+2581 is a space, ``<0xHH>`` a byte, all else UTF-8."""
    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return model, [bytes.fromhex(p[3:5]) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", p) else p.replace("▁", " ").encode() for p in names]
