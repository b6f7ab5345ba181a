"""Secret scans: plain patterns, and a linear-chain conditional random field that tags every token of a text."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from verdigrid.llm import secret_forms
from verdigrid.llm.common import map_batches

#: The base patterns; fixed values. Runs of hexadecimal digits are asked for at their full length, as shorter ones are dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "crf"]
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: Documents that the random field is fitted on, at most; windows of theirs, and made-up secrets and clean texts set in them.
SAMPLE_ROWS, NATURAL, MADE_UP = 4000, 600, 1400
#: A token may be odd from this length on; characters of its line that are tagged with it on either side.
SUSPICIOUS, SIDE = 12, 240
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+|[^\sA-Za-z0-9+/_-]", re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % SUSPICIOUS)
KEYWORD = re.compile(r"pass(?:word|wd|phrase|code)|pwd|secret|token|(?<![A-Za-z])key|[_-]key|apikey|(?<![A-Za-z])auth(?![A-Za-z])|authorization|auth_|credential|bearer|://[^\s/:]*:", re.I | re.A)
OTHERS = re.compile("[^b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]+")  # all but consonants
#: Of each character up to 128, which stands for all above: 0 white space, 1 in a token's run, 2 a token of its own.
CHARACTERS = np.array([0 if chr(c) in " \t\n\r\f\v" else 1 if c < 128 and (chr(c).isalnum() or chr(c) in "+/_-") else 2 for c in range(129)], np.uint8)
HEX_DIGITS = set("0123456789abcdef")
OUT, BEGIN, INSIDE = 0, 1, 2
FEATURES = 1 << 13

Span = tuple[int, int, int]  # start, kind, end


class Field(NamedTuple):
    """Weights of the random field: of hashed token features by tag, and of tag pairs."""
    emit: np.ndarray
    step: np.ndarray


def base_spans(text: str) -> list[Span]:
    """Spans of the three plain patterns, leftmost and non-overlapping for each kind, in code points."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def odd(token: str) -> bool:
    """Digits among letters, or letters that change case again and again."""
    letters = any(c.isalpha() for c in token)
    return letters and (any(c.isdigit() for c in token) or sum(a.islower() and b.isupper() for a, b in zip(token, token[1:])) > 2)


def suspicious(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if odd(m[0])]


def windows(text: str, found: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Token spans of every stretch around odd tokens (``found``) and key words: their lines, of long lines ``SIDE`` characters on either side.

    Stretches that meet are one. The field is fitted on such; it tags whole texts.
    """
    marks = sorted([*found, *[m.span() for m in KEYWORD.finditer(text)]])
    low = high = -1
    for a, b in [*marks, (len(text) + 1, len(text) + 1)]:
        if a > high:
            if high >= 0:
                yield [m.span() for m in TOKEN.finditer(text, low, high)]
            if a > len(text):
                return
            low = max(text.rfind("\n", 0, a) + 1, a - SIDE)
            while low and low < a and not text[low - 1].isspace():  # a token is not cut
                low += 1
        end = text.find("\n", b)
        high = max(high, min(len(text) if end < 0 else end, b + SIDE))
        while high < len(text) and high > b and not text[high].isspace():
            high -= 1


def is_key(token: str) -> bool:
    """Whether ``KEYWORD`` is found in a token; most lack what all its words have."""
    low = token.lower()
    return (("pass" in low or "pwd" in low or "secret" in low or "token" in low or "key" in low or "auth" in low or "credential" in low or "bearer" in low)
            and bool(KEYWORD.search(token)))


def _shape(token: str) -> list[str]:
    n = len(token)
    digits, lower, upper = (sum(f(c) for c in token) for f in (str.isdigit, str.islower, str.isupper))
    kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o" for c in token]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    longest = max(map(len, OTHERS.split(token)))
    size = next((x for x in (1, 2, 3, 4, 6, 8, 12, 16, 20, 32) if n <= x), 33)
    out = [f"n{size}", f"d{min(4, digits * 5 // n)}l{min(4, lower * 5 // n)}u{min(4, upper * 5 // n)}", f"t{min(turns, 8)}", f"tn{turns * 6 // n}",
           f"v{len(set(token)) * 4 // n}", f"h{HEX_DIGITS.issuperset(token)}", f"c{min(longest, 6)}"]
    if digits and lower + upper:
        out += [f"mix{min(turns, 6)}", f"mixn{min(n // 4, 8)}", f"mixk{bool(lower)}{bool(upper)}{n >= SUSPICIOUS}"]
    if lower and upper:
        out += [f"case{min(turns, 6)}&{n >= SUSPICIOUS}"]
    if n == 1:
        out.append(f"c{token}")
    return out


def features(text: str, tokens: list[tuple[int, int]], share: float) -> list[list[int]]:
    """Hashed features of each token: its shape, its neighbours' shapes, key words and joints, and the document's share of odd text."""
    words = [text[a:b] for a, b in tokens]
    shapes = [_shape(w) for w in words]
    keys = [bool(KEYWORD.search(w)) for w in words]
    joined = [i > 0 and tokens[i][0] == tokens[i - 1][1] for i in range(len(tokens))] + [False]
    rows = []
    for i, own in enumerate(shapes):
        kind = own[1]
        names = [*own, f"f{min(3, int(share * 20))}&{own[-1]}", f"j{joined[i]}{joined[i + 1]}", f"j{joined[i]}&{kind}", f"key{keys[i]}"]
        near = False
        for d in (-4, -3, -2, -1, 1):
            j = i + d
            if 0 <= j < len(words):
                names += [f"{d}:{shapes[j][1]}&{joined[max(i, j)]}" if abs(d) == 1 else f"{d}c{words[j]}" if len(words[j]) == 1 else f"{d}w"]
                if abs(d) == 1 and len(words[j]) == 1:
                    names.append(f"{d}s{words[j]}&{joined[max(i, j)]}")
                if keys[j]:
                    names.append(f"{d}key")
                    near = near or d < 0
            else:
                names.append(f"{d}edge")
        names += [f"near{near}&{kind}", f"near{near}&{own[2]}", f"near{near}&{own[0]}"]
        rows.append([xxhash.xxh32_intdigest(x) % FEATURES for x in names])
    return rows


def _share(text: str, found: list[tuple[int, int]]) -> float:
    return sum(b - a for a, b in found) / max(len(text), 1)


def tags_of(tokens: list[tuple[int, int]], values: list[tuple[int, int]]) -> list[int]:
    """Tags of tokens that lie in one of some spans."""
    out, last = [], None
    for a, b in tokens:
        hit = next((v for v in values if v[0] <= a and b <= v[1]), None)
        out.append(OUT if hit is None else INSIDE if hit == last else BEGIN)
        last = hit
    return out


def plain_values(text: str) -> list[tuple[int, int]]:
    """The values that the plain patterns find: of an assignment if it has a digit, a key, a digest."""
    values = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN and any(c.isdigit() for c in m[2])]
    return values + [(a, b) for a, kind, b in base_spans(text) if kind]


def _forward(emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    out = np.empty_like(emit)
    out[0] = emit[0]
    for t in range(1, len(emit)):
        out[t] = emit[t] + np.logaddexp.reduce(out[t - 1][:, None] + step, axis=0)
    return out


def fit_field(sequences: list[tuple[list[list[int]], list[int]]], steps: int = 4000, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """Maximise the likelihood of tagged sequences by gradient steps over forward-backward marginals; INSIDE never follows OUT."""
    passes = max(4, -(-steps // len(sequences)))
    emit, step = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    step[OUT, INSIDE] = -1e4
    rng = np.random.default_rng(0)
    for _ in range(passes):
        for k in rng.permutation(len(sequences)):
            rows, tags = sequences[k]
            score = np.array([emit[r].sum(axis=0) for r in rows])
            score[0, INSIDE] -= 1e4
            ahead = _forward(score, step)
            behind = _forward(score[::-1], step.T)[::-1] - score
            total = np.logaddexp.reduce(ahead[-1])
            marginal = np.exp(ahead + behind - total)
            for r, tag, p in zip(rows, tags, marginal):
                grad = -p
                grad[tag] += 1
                np.add.at(emit, r, rate * grad - decay * emit[r])
            for t in range(1, len(rows)):
                pair = np.exp(ahead[t - 1][:, None] + step + score[t] + behind[t] - total)
                pair = -pair
                pair[tags[t - 1], tags[t]] += 1
                step += rate * 0.1 * pair
            step[OUT, INSIDE] = -1e4
    return Field(emit, step)


def best_path(score: np.ndarray, step: np.ndarray) -> list[int]:
    """The best sequence of tags by the tokens' scores; with equal scores the lower tag."""
    if len(score) == 1:
        return [int(score[0].argmax())]
    steps = step.tolist()
    best, back = score[0].tolist(), []
    for row in score[1:].tolist():
        total = [[best[i] + steps[i][j] for i in range(3)] for j in range(3)]
        came = [t.index(max(t)) for t in total]
        back.append(came)
        best = [t[c] + r for t, c, r in zip(total, came, row)]
    tags = [best.index(max(best))]
    for came in reversed(back):
        tags.append(came[tags[-1]])
    return tags[::-1]


def viterbi(field: Field, rows: list[list[int]]) -> list[int]:
    """The best sequence of tags of tokens with these features."""
    score = np.array([field.emit[r].sum(axis=0) for r in rows])
    score[0, INSIDE] -= 1e4
    return best_path(score, field.step)


def token_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all matches of ``TOKEN``: runs of its characters, and every other character but white space alone."""
    kinds = np.pad(CHARACTERS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)], 1)
    here, run = kinds[1:-1], kinds == 1
    alone = here == 2
    return np.flatnonzero(alone | run[1:-1] & ~run[:-2]), np.flatnonzero(alone | run[1:-1] & ~run[2:]) + 1


class Tagger:
    """The random field for whole texts. A token's score, that of ``features``, is a sum of rows looked up by its word, its
    neighbours' kinds and joints; words and kinds met before are known by number."""

    KNOWN = 200_000  # words kept by number, at most: above, all are forgotten and met anew
    BEFORE, MARGIN = 4, 1e-6
    PATTERN = str.maketrans({chr(c): "d" if chr(c).isdigit() else "l" if chr(c).islower() else "u" if chr(c).isupper() else "o" for c in range(33, 127)})

    def __init__(self, field: Field) -> None:
        self.field, self.step = field, field.step
        self.joint = np.array([[self._score([f"j{a}{b}"]) for b in (False, True)] for a in (False, True)])
        self.edges = {d: self._score([f"{d}edge"]) for d in (-4, -3, -2, -1, 1)}
        self.words: dict[str, int] = {}  # a word's form: all words of a form have the same features
        self.forms: dict[tuple, int] = {}
        self.own, self.kind_of = np.zeros((1024, 3)), np.zeros(1024, np.int64)
        self.kinds: dict[tuple, int] = {}
        self.base, self.near, self.far = np.zeros((64, 4, 4, 3)), np.zeros((64, 4, 3)), np.zeros((64, 3, 3))
        self.key = np.zeros(64, bool)
        step, out, other = field.step, OUT, (BEGIN, INSIDE)
        # least that a path gains by OUT in place of another tag at a token: from the tag before, from the next one, from a BEGIN for an INSIDE after it
        self.gain_before = [min(0.0, *(step[:, out] - step[:, x])) for x in other]
        self.gain_after = [min(0.0, *(step[out, q] - step[x, q] for q in (OUT, BEGIN))) for x in other]
        self.gain_begin = [step[out, BEGIN] - step[x, INSIDE] + min(0.0, *(step[BEGIN] - step[INSIDE])) for x in other]

    def _score(self, names: list[str]) -> np.ndarray:
        return self.field.emit[[xxhash.xxh32_intdigest(x) % FEATURES for x in names]].sum(axis=0)

    def _learn(self, word: str) -> int:
        n = len(word)
        if n == 1:
            form = (word,)
        else:  # all that ``_shape`` and the key words ask of a longer token, which is ASCII
            chars = set(word)
            form = (word.translate(self.PATTERN), len(chars) * 4 // n, chars <= HEX_DIGITS, min(6, max(map(len, OTHERS.split(word)))), is_key(word))
        number = self.forms.get(form)
        if number is None:
            number = self.forms[form] = len(self.forms)
            if number == len(self.own):
                self.own, self.kind_of = [np.concatenate([x, np.zeros_like(x)]) for x in (self.own, self.kind_of)]
            own = _shape(word)
            self.own[number] = self._score(own)
            kind = (own[0], own[1], own[2], own[-1], word if n == 1 else "", is_key(word))
            if kind not in self.kinds:
                self._learn_kind(kind)
            self.kind_of[number] = self.kinds[kind]
        if len(self.words) >= self.KNOWN:
            self.words.clear()
        self.words[word] = number
        return number

    def _learn_kind(self, kind: tuple) -> None:
        number = self.kinds[kind] = len(self.kinds)
        if number == len(self.base):
            self.base, self.near, self.far, self.key = [np.concatenate([x, np.zeros_like(x)]) for x in (self.base, self.near, self.far, self.key)]
        size, share, turns, last, char, key = kind
        # its own score by key word near and joint before, and by the document's share of odd text
        for i, (near, joined) in enumerate((n, j) for n in (False, True) for j in (False, True)):
            for level in range(4):
                self.base[number, i, level] = self._score([f"f{level}&{last}", f"j{joined}&{share}", f"key{key}", f"near{near}&{share}", f"near{near}&{turns}", f"near{near}&{size}"])
        # what it adds to the next token, to the one before, and to those from two to four places on
        for i, (d, joined) in enumerate((d, j) for d in (-1, 1) for j in (False, True)):
            self.near[number, i] = self._score([f"{d}:{share}&{joined}", *([f"{d}s{char}&{joined}"] if char else []), *([f"{d}key"] if key else [])])
        for i, d in enumerate((-2, -3, -4)):
            self.far[number, i] = self._score([f"{d}c{char}" if char else f"{d}w", *([f"{d}key"] if key else [])])
        self.key[number] = key

    def scores(self, words: list[str], starts: np.ndarray, ends: np.ndarray, share: float) -> np.ndarray:
        """Score of every tag for every token (one at least) of a text."""
        known, learn = self.words.get, self._learn
        ids = np.array([learn(w) if (k := known(w)) is None else k for w in words])
        n = len(ids)
        joined = np.zeros(n + 1, np.int64)
        joined[1:n] = starts[1:] == ends[:-1]
        kinds = self.kind_of[ids]
        key, near = self.key[kinds], np.zeros(n, bool)
        for d in range(1, self.BEFORE + 1):
            near[d:] |= key[:-d]
        out = self.own[ids]
        out += self.base[kinds, 2 * near + joined[:n], min(3, int(share * 20))]
        out += self.joint[joined[:n], joined[1:]]
        out[1:] += self.near[kinds[:-1], joined[1:n]]
        out[:-1] += self.near[kinds[1:], 2 + joined[1:n]]
        out[0] += self.edges[-1]
        out[-1] += self.edges[1]
        for d in (2, 3, 4):
            out[d:] += self.far[kinds[:-d], d - 2]
            out[:d] += self.edges[-d]
        return out

    def tags(self, score: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(place, tags) of the stretches that may hold other tags than OUT; all tags are those of the best path over the whole text.

        At a token where OUT in place of any other tag makes any path better, whatever stands around, the best path has OUT. The path
        is looked for between such tokens.
        """
        score[0, INSIDE] -= 1e4
        begin = np.append(score[1:, BEGIN] - score[1:, INSIDE], 0.0)
        sure = np.ones(len(score), bool)
        for i, x in enumerate((BEGIN, INSIDE)):
            after = np.minimum(self.gain_after[i], self.gain_begin[i] + begin)
            sure &= score[:, OUT] - score[:, x] + self.gain_before[i] + after > self.MARGIN
        # a token between two of these: the tags around it are known
        alone = np.flatnonzero(~sure[1:-1] & sure[:-2] & sure[2:]) + 1
        at_one = score[alone] + (self.step[OUT] + self.step[:, OUT])
        sure[alone[at_one.argmax(axis=1) == OUT]] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[True], sure, [True]]).astype(np.int8)))
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            part = score[a:b].copy()
            if a:
                part[0] += self.step[OUT]
            if b < len(score):
                part[-1] += self.step[:, OUT]
            yield a, best_path(part, self.step)


def field_spans(text: str, field: Field, tagger: Tagger | None = None) -> list[Span]:
    """Spans that the random field tags in the whole text, a single sequence of tokens; a span runs from a BEGIN token to its last INSIDE token."""
    out: list[Span] = []
    words = TOKEN.findall(text)
    if not words:
        return out
    tagger = tagger or Tagger(field)
    starts, ends = token_places(text)
    for place, tags in tagger.tags(tagger.scores(words, starts, ends, _share(text, suspicious(text)))):
        for i, tag in enumerate(tags, place):
            if tag == BEGIN:
                out.append((int(starts[i]), 3, int(ends[i])))
            elif tag == INSIDE and out:
                out[-1] = (out[-1][0], 3, int(ends[i]))
    return out


def all_spans(text: str, field: Field, tagger: Tagger | None = None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): the random field adds spans that no base span touches; base spans stay."""
    base = base_spans(text)
    starts: list[int] = []
    ends: list[int] = []  # base spans that meet as one
    for a, _, b in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(span: Span) -> bool:
        before = bisect_left(starts, span[2]) - 1
        return before < 0 or ends[before] <= span[0]

    return base, sorted(base + [s for s in field_spans(text, field, tagger) if free(s)])


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def tagged(snippets: list[tuple[str, list[tuple[int, int]]]], share: float = 0.0) -> list[tuple[list[list[int]], list[int]]]:
    """Features and tags of whole snippets (text, spans of secrets)."""
    out = []
    for text, values in snippets:
        tokens = [m.span() for m in TOKEN.finditer(text)]
        if tokens:
            out.append((features(text, tokens, share), tags_of(tokens, values)))
    return out


def made_up(words: list[list[str]], n: int, forms: list[str], seed: int = 0) -> list[tuple[str, list[tuple[int, int]]]]:
    """``n`` snippets of the given words, three in five with a made-up secret and the others with what is none."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        around = rng.choice(words) if words else []
        at = rng.randrange(len(around)) if around else 0
        some = around[at:at + rng.randint(2, 10)]
        text, a, b = secret_forms.planted(rng, some, forms) if k % 5 < 3 else secret_forms.clean(rng, some)
        out.append((text, [(a, b)] if b > a else []))
    return out


def fit_secrets(docs: DataFrame, rows: int = SAMPLE_ROWS, forms: list[str] | None = None) -> Field:
    """Fit the random field on at most ``rows`` documents, those whose ids hash lowest.

    It learns from secrets of many forms (``forms`` of ``secret_forms.FORMS``) that are made up by a fixed seed and set among the
    documents' words, from like texts without a secret, and from the documents' own windows, whose tags come from the plain patterns.
    """
    ids = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.lit(1).alias("_one")).drop("_one")
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids

    def cut(batch: dict) -> dict:
        """The first window of a document and some words from a place that its text decides."""
        out = {"doc_id": [str(d) for d in batch["doc_id"]], "window": [], "words": []}
        for text in batch["text"]:
            text = text or ""
            tokens = next(windows(text, suspicious(text)), [])
            out["window"].append(text[tokens[0][0]:min(tokens[-1][1], tokens[0][0] + 4 * SIDE)] if tokens else "")
            at = xxhash.xxh32_intdigest(text) % max(1, len(text) - 2 * SIDE)
            out["words"].append(text[at:at + 2 * SIDE].split()[1:-1])
        return out

    found = (map_batches(sample, cut, "doc_id string, window string, words array<string>")
             .groupBy("doc_id").agg(F.min(F.struct("window", "words")).alias("one")).orderBy("doc_id").collect())
    words = [r["one"]["words"] for r in found if r["one"]["words"]]
    own = sorted({r["one"]["window"] for r in found} - {""})[:NATURAL]
    plain = [(" ".join(w[:20]), []) for w in words[:NATURAL]]
    made = made_up(words, MADE_UP, forms or list(secret_forms.FORMS))
    known = tagged([(w, plain_values(w)) for w in own] + plain + made)
    first = fit_field(known)
    # what that field takes for secrets in the plain prose of the sample, far from key words and odd tokens, is shown to it as prose
    tagger = Tagger(first)
    hard = [text for text in (" ".join(w) for w in words) if any(_plain_prose(text, s) for s in field_spans(text, first, tagger))]
    return fit_field(known + tagged([(text, plain_values(text)) for text in hard[:NATURAL]])) if hard else first


def _plain_prose(text: str, span: Span) -> bool:
    """Whether a span has neither an odd token nor a digit, and no key word in it or shortly before."""
    inside = text[span[0]:span[2]]
    return not (any(c.isdigit() for c in inside) or any(odd(m[0]) for m in TOKEN.finditer(inside)) or KEYWORD.search(text, max(0, span[0] - 2 * SUSPICIOUS), span[2]))


def scan_secrets(docs: DataFrame, field: Field, masked: str | None = None, text: str = "text") -> DataFrame:
    """Add n_assign, n_access, n_hex, base_sha256 and spans to ``docs``; with ``masked``, instead the text with each span replaced by it.

    A null text is empty: no spans, and it stays null when masked. Columns of these names are replaced; rows are scanned
    each, also repeated ones. Whole texts of any length; one pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(field))  # plain arrays of FEATURES x 3 and 3 x 3 weights
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    source = docs if masked is not None else docs.select(*[c for c in docs.columns if c not in names])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)

    taggers: list[Tagger] = []  # one a task: the function is sent to each anew

    def run(batch: dict) -> dict:
        if not taggers:
            taggers.append(Tagger(Field(*shared.value)))
        found = [all_spans(t or "", taggers[0].field, taggers[0]) for t in batch[text]]
        if masked is not None:
            return {**batch, text: [mask(t, spans, masked) for t, (_, spans) in zip(batch[text], found)]}
        counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(3)]
        return {**batch, **dict(zip(names, counts)), "base_sha256": [hashlib.sha256(written_out(base).encode()).hexdigest() for base, _ in found],
                "spans": [written_out(spans) for _, spans in found]}

    more = "" if masked is not None else ", n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_batches(source, run, fields + more)


def mask(text: str | None, spans: list[Span], by: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], by]
        at = max(at, b)
    return "".join([*out, text[at:]])
