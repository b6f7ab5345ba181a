"""Licence scans by sentence rules: sentences become known identifiers, identifier sequences match ordered rules.

Column expressions only; each document is looked at on its own, in one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Known licence sentences in normal form (lower case, one space between runs of a-z and 0-9), numbered from 1.
SENTENCES = [
    "released under the mit license",
    "licensed under the apache license version 2 0",
    "this work is licensed under the gnu general public license version 3",
    "licensed under cc by nc 4 0",
    "all rights reserved",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "this work is dedicated to the public domain under cc0 1 0",
    "released under the bsd 3 clause license",
    "licensed under the mozilla public license version 2 0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "the above copyright notice and this permission notice shall be included in all copies",
    "the software is provided as is without warranty of any kind",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license",
    "this program is free software you can redistribute it and or modify it",
    "this program is distributed in the hope that it will be useful but without any warranty",
    "redistributions of source code must retain the above copyright notice",
    "redistributions in binary form must reproduce the above copyright notice",
]
#: Ordered rules: (licence, identifiers of its sentences in order). All that match are reported, in this order.
RULES = [
    ("MIT", [1]), ("Apache-2.0", [2]), ("GPL-3.0", [3]), ("CC-BY-NC-4.0", [4]), ("proprietary", [5]), ("CC-BY-4.0", [6]),
    ("CC-BY-SA-4.0", [7]), ("CC0-1.0", [8]), ("BSD-3-Clause", [9]), ("MPL-2.0", [10]),
    ("MIT-text", [11, 12, 13]), ("Apache-2.0-text", [2, 14, 15]), ("GPL-3.0-notice", [16, 17]), ("BSD-text", [18, 19, 13]),
]
#: The sentences of the published texts in full, in normal form, numbered on from ``SENTENCES``; those of one entry are the same sentence.
PUBLISHED = [
    ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal "
     "in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
     "of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
     "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness "
     "for a particular purpose and noninfringement"],
    ["licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"],
    ["you may obtain a copy of the license at", "you may obtain a copy of the license at http www apache org licenses license 2 0",
     "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied"],
    ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation either version 3 of the license or at your option any later version"],
    ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness "
     "for a particular purpose"],
    ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
     "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and "
     "or other materials provided with the distribution"],
    [f"this software is provided by the {holder} as is and any express or implied warranties including but not limited to the implied warranties of "
     "merchantability and fitness for a particular purpose are disclaimed"
     for holder in ("copyright holders and contributors", "copyright holder and contributors", "regents and contributors", "author and contributors")],
]
PUBLISHED_RULES = [("Apache-2.0", [23]), ("MIT-text", [20, 21, 22]), ("Apache-2.0-text", [23, 24, 25]), ("GPL-3.0-notice", [26, 27]), ("BSD-text", [28, 29, 30])]
#: Unknown sentences that may lie between two sentences of one rule.
MAX_GAP = 3
#: A sentence ends at a line feed, or after a full stop, an exclamation or question mark with white space behind it.
SENTENCE_END = r"\n|[.!?][ \t\r\f]+"


#: What begins a line of a comment; and where a sentence ends in a text of wrapped lines: at a blank line, or after a mark with white space behind it.
COMMENT = r"(?:^|\n)[ \t\r/*#;%<>|!-]*(?:(?i:dnl|rem)(?![A-Za-z0-9]))?(?:[ \t\r]*\(?[0-9a-z]\)(?=[ \t]))?[ \t\r]*"
WRAPPED_END = r"\n\n+|[.!?][ \t\r\f\n]+"


def _numbered(text: Column, end: str, known: list[tuple[str, int]]) -> Column:
    numbers = F.create_map(*[F.lit(x) for pair in known for x in pair])
    normal = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    return F.transform(F.split(text, end), lambda s: F.coalesce(F.try_element_at(numbers, normal(s)), F.lit(0)))


def sentence_ids(text: Column) -> Column:
    """The identifier of every sentence in order, 0 for an unknown one."""
    return _numbered(F.coalesce(text, F.lit("")), SENTENCE_END, [(s, n) for n, s in enumerate(SENTENCES, 1)])


def wrapped_ids(text: Column) -> Column:
    """The same for a text whose sentences go on over lines, also in comments; with the published sentences."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), COMMENT, "\n")
    known = [(s, n) for n, forms in enumerate([*([s] for s in SENTENCES), *PUBLISHED], 1) for s in forms]
    # the later of two equal sentences is the published one
    return _numbered(plain, WRAPPED_END, list(dict(known).items()))


def _line(ids: str) -> Column:
    """Known identifiers as ``,1,|,2,``: a bar stands where the gap is too long for one rule."""
    line = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    line = F.regexp_replace(line, f"(,0){{{MAX_GAP + 1},}}(?=,)", ",|")
    return F.regexp_replace(line, "(,0)+(?=,)", "")


def scan_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add to ``docs``: n_sentences, sentence_ids (``position:identifier`` of known sentences) and licences, both comma-joined.

    A rule matches where its identifiers follow each other in order with at most ``MAX_GAP`` unknown sentences between two.
    Licences are looked for in two readings: one where each line feed ends a sentence, which n_sentences and sentence_ids
    tell of, and one where only a blank line does and comment marks are left out, which also knows the published texts.
    A null or empty text has one empty, unknown sentence and no licence; repeated rows are scanned each.
    """
    found = docs.withColumns({"_ids": sentence_ids(F.col(text)), "_wrapped": wrapped_ids(F.col(text))})
    at = F.filter(F.transform("_ids", lambda x, i: F.when(x > 0, F.concat(i.cast("string"), F.lit(":"), x.cast("string")))), lambda x: x.isNotNull())
    has = lambda line, ids: F.contains(line, F.lit("," + ",".join(map(str, ids)) + ","))

    def hit(name: str, ids: list[int]) -> Column:
        out = has("_line", ids) | has("_lines", ids)
        for other, published in PUBLISHED_RULES:
            out = out | has("_lines", published) if other == name else out
        return F.when(out, F.lit(name))

    hits = F.array(*[hit(name, ids) for name, ids in RULES])
    return (found.withColumns({"_line": _line("_ids"), "_lines": _line("_wrapped")})
            .withColumns({"n_sentences": F.size("_ids").cast("bigint"), "sentence_ids": F.array_join(at, ","),
                          "licences": F.array_join(F.array_compact(hits), ",")})
            .drop("_ids", "_wrapped", "_line", "_lines"))


def licences_sql(table: str = "documents") -> str:
    """The reading by lines in DuckDB. It knows neither wrapped sentences nor the published texts, so it equals the scan on tables without these, as the given ones."""
    known = ", ".join(f"'{s}': {n}" for n, s in enumerate(SENTENCES, 1))
    hits = ", ".join(f"CASE WHEN contains(line, ',{','.join(map(str, ids))},') THEN '{name}' END" for name, ids in RULES)
    return f"""
WITH ids AS (SELECT doc_id, list_transform(string_split_regex(coalesce(text, ''), '{SENTENCE_END}'),
    lambda s: coalesce(MAP {{{known}}}[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))], 0)) AS ids FROM {table}),
runs AS (SELECT doc_id, ids, regexp_replace(',' || array_to_string(ids, ',') || ',', '(,0){{{MAX_GAP + 1},}},', ',|,', 'g') AS bars FROM ids),
lines AS (SELECT doc_id, ids, regexp_replace(bars, '(,0)+,', ',', 'g') AS line FROM runs)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences,
  coalesce(array_to_string(list_filter(list_transform(ids, lambda x, i: CASE WHEN x > 0 THEN (i - 1) || ':' || x END), lambda x: x IS NOT NULL), ','), '') AS sentence_ids,
  coalesce(array_to_string(list_filter([{hits}], lambda x: x IS NOT NULL), ','), '') AS licences
FROM lines"""
