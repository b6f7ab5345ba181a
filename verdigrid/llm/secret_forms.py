"""Made-up secrets of many forms in ordinary surroundings, and surroundings without any: what the random field learns from."""

from __future__ import annotations

import random
import string

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
MIXED = LOWER + UPPER + DIGITS

Planted = tuple[str, int, int]  # text, start and end of the secret in it (equal: none)


def _of(rng: random.Random, signs: str, low: int, high: int, *must: str) -> str:
    out = [rng.choice(signs) for _ in range(rng.randint(low, high))]
    for place, group in zip(rng.sample(range(len(out)), len(must)), must):
        out[place] = rng.choice(group)
    return "".join(out)


#: Forms of secrets by name: each makes one from a random source.
FORMS = {
    "mixed": lambda r: _of(r, MIXED, 12, 44, LOWER, UPPER, DIGITS),
    "letters": lambda r: _of(r, LOWER + UPPER, 16, 32, LOWER, UPPER),
    "lower": lambda r: _of(r, LOWER + DIGITS, 16, 40, LOWER, DIGITS),
    "upper": lambda r: _of(r, UPPER + DIGITS, 16, 32, UPPER, DIGITS),
    "hex": lambda r: _of(r, DIGITS + "abcdef", 20, 64, "abcdef", DIGITS),
    "base64": lambda r: _of(r, MIXED + "+/", 24, 60, LOWER, UPPER, DIGITS) + r.choice(["", "", "=", "=="]),
    "prefixed": lambda r: _of(r, LOWER, 2, 4) + r.choice(["_", "_live_", "_test_", "-"]) + _of(r, MIXED, 16, 40, LOWER, UPPER, DIGITS),
    "dashed": lambda r: _of(r, LOWER, 3, 5) + "-" + _of(r, DIGITS, 9, 12) + "-" + _of(r, MIXED, 16, 28, LOWER, UPPER, DIGITS),
    "dotted": lambda r: ".".join(_of(r, MIXED + "-_", 12, 36, LOWER, UPPER, DIGITS) for _ in range(3)),
    "symbols": lambda r: _of(r, MIXED + "!@#$%^&*?", 8, 14, LOWER, UPPER, DIGITS, "!@#$%^&*?"),
}
#: Forms that stand out without a key word beside them.
BARE = {"mixed", "hex", "base64", "prefixed", "dashed", "dotted", "lower", "upper"}
KEYS = ["password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "access_key", "auth_token", "client_secret", "private_key", "credentials", "key",
        "secret_access_key", "DB_PASSWORD", "API_TOKEN", "Secret", "Password"]
WITH_KEY = ["{k} = {v}", "{k}: {v}", "{k}={v}", '"{k}": "{v}"', "{k} {v}", "{k} is {v}", "{k} '{v}'", "--{k} {v}", "export {k}={v}", "my_{k}: {v}", "{k} -> {v}", "aws_{k} {v}"]
OTHERS = ["Authorization: Bearer {v}", "bearer {v}", "https://user:{v}@host.example/db", "auth {v}"]
#: What looks like a secret at first sight and is none.
CLEAN = ["{k}", "the {k} {w} {w}", "{k}: {w}", "a {k} is {w} {w}", "{k} = {w}", "press any {k} to {w}", "see chapter{n} of {w}", "IMG_{n}{n}{n}.jpg", "call {n}-{n}-{n}{n}", "{n}.{n}.{n}.{n}",
         "20{n}-0{d}-1{d}", "{w}{W}{W}{W}", "{w}_{w}_{w}_{w}", "https://www.{w}.example/{w}/{w}-{w}-{n}", "{w}.{w}@{w}.example", "{n}{n}{n}{n}{n}{n}{n}{n}", "version {d}.{n}.{d}", "{w}{w}{w}", "{w}-{w}-{w}",
         "{W}{W}{W}", "the {k} of {w}{n} and {w}", "order {n}{n}{n} of {w}"]


def planted(rng: random.Random, words: list[str], forms: list[str]) -> Planted:
    """One secret among some words."""
    form = rng.choice(forms)
    value = FORMS[form](rng)
    kinds = [WITH_KEY] * 3 + [OTHERS] + ([["{v}", '"{v}"', "({v})"]] if form in BARE and len(value) >= 20 else [])
    snippet = rng.choice(rng.choice(kinds)).replace("{k}", rng.choice(KEYS))
    at = rng.randint(0, len(words))
    before = " ".join(words[:at]) + (" " if at else "")
    start = len(before) + snippet.index("{v}")
    text = before + snippet.replace("{v}", value) + rng.choice([" ", ". ", ", ", "\n"]) + " ".join(words[at:])
    return text, start, start + len(value)


def clean(rng: random.Random, words: list[str]) -> Planted:
    """The same without a secret: key words beside ordinary words, numbers, addresses, names of files and of variables."""
    fill = {"{k}": lambda: rng.choice(KEYS), "{w}": lambda: rng.choice(words or ["word"]).strip(string.punctuation).lower() or "word", "{W}": lambda: (rng.choice(words or ["word"]).strip(string.punctuation) or "word").capitalize(),
            "{n}": lambda: str(rng.randint(10, 99)), "{d}": lambda: str(rng.randint(1, 9))}
    snippet = rng.choice(CLEAN)
    for mark, make in fill.items():
        while mark in snippet:
            snippet = snippet.replace(mark, make(), 1)
    at = rng.randint(0, len(words))
    return " ".join([*words[:at], snippet, *words[at:]]), 0, 0
