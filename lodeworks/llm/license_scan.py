"""License scans over a positional rare-token index, in built-in functions only.

One pass keeps every text as a codes array in a table in the shared folder: for each word its hash if it occurs in any
template (a licence word), else 0; all further steps read that. Document frequencies of the licence words over all
documents give their IDF; each template is looked up by the ANCHORS rarest words of its key phrase. That phrase must stand
complete, so no text is missed, whichever other words differ. An anchor's place in a text less its place in the template
is a start (below 0 where a text begins within the template); the anchors' starts are intersected, and every start is
scored by the share of the template's words that stand at their relative places, which the codes array tells at once: the
work is linear in a text's length. No text is joined or shuffled; the only shuffle counts licence words, of which there
are a few hundred.

Defined cases: null texts are empty; a text without licence words has score 0 and no labels; repeated rows are scanned
alike, each by itself; very long texts are scanned whole; empty tables give empty results; extra columns pass by unread,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table
from .decontaminate import SEPARATORS

#: Phrases that give a label wherever they stand complete (fixed values).
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Templates: label, text, the key phrase that must stand complete in it (fixed values).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("apache-2", "licensed under the apache license 2 0", "apache license 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]
#: Rarest words of its key phrase by which a template is looked up, and share of a template's words that must stand in their places.
ANCHORS, COVERAGE = 2, 0.7


def _templates() -> list[tuple[str, list[str], tuple[int, int], bool]]:
    """(label, words, where the key phrase stands, exact); phrases first."""
    out = []
    for exact, label, text, key in [*((True, a, b, b) for a, b in PHRASES), *((False, *t) for t in TEMPLATES)]:
        words, part = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(part)] == part)
        out.append((label, words, (at, at + len(part)), exact))
    return out


def licence_words() -> list[str]:
    return sorted({w for _, words, _, _ in _templates() for w in words})


def places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words and codes: for each word its hash if it is a licence word, else 0; empty without any of those."""
    df = docs.select(F.col(id_col).alias("id"), F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), SEPARATORS), "").alias("w"))
    known = ", ".join(f"'{w}'" for w in licence_words())
    df = df.select("id", F.size("w").cast("long").alias("n_words"), F.expr(f"transform(w, x -> if(x in ({known}), hash(x), 0))").alias("codes"))
    return df.withColumn("codes", F.expr("if(exists(codes, c -> c != 0), codes, cast(array() as array<int>))"))


def anchors(placed: DataFrame) -> tuple[dict[str, int], list[list[int]]]:
    """The licence words' hashes; and for each template the positions of the ANCHORS words of its key phrase with the
    highest IDF over all documents."""
    words = licence_words()
    code = dict(zip(words, placed.sparkSession.range(1).select(*(F.hash(F.lit(w)) for w in words)).first(), strict=True))
    found = placed.select(F.explode(F.array_distinct("codes")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    df = {r.code: r.n for r in found.collect()}  # at most as many rows as there are licence words
    return code, [sorted(range(*key), key=lambda i, w=w: (df.get(code[w[i]], 0), i))[:ANCHORS] for _, w, key, _ in _templates()]


def _starts(codes: list[int], at: list[int]) -> str:
    """Where a template can begin by its anchors."""
    each = [f"transform(filter(anchored, o -> o.code = {codes[i]}), o -> o.at - {i})" for i in at]
    out = each[0]
    for more in each[1:]:
        out = f"array_intersect({out}, {more})"
    return f"array_distinct({out})"


def _found(label: str, codes: list[int], low: int, high: int, at: list[int], least: float) -> str:
    """The starts at which a template's share of words in place is at least `least` and its key phrase is complete."""
    template = f"array({', '.join(map(str, codes))})"
    same = f"get(codes, s + k) = get({template}, k)"
    key = f"coalesce(forall(sequence({low}, {high - 1}), k -> {same}), false)"
    share = f"size(filter(sequence(0, {len(codes) - 1}), k -> {same})) / {len(codes)}D"
    scored = f"transform({_starts(codes, at)}, s -> struct('{label}' as label, s as start, if({key}, {share}, 0D) as coverage))"
    return f"filter({scored}, x -> x.coverage >= {least})"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_words, base (starts of phrases with labels) and found (templates: label, start, coverage)."""
    placed = table(places(docs, id_col, text_col), "licence-words")
    code, chosen = anchors(placed)
    known = _templates()
    rare = sorted({code[w[i]] for (_, w, _, _), at in zip(known, chosen, strict=True) for i in at})
    anchored = f"filter(transform(codes, (c, i) -> if(c in ({', '.join(map(str, rare))}), struct(i as at, c as code), null)), x -> x is not null)"
    df = placed.withColumn("anchored", F.expr(anchored))
    kind = "array<struct<label:string,start:int,coverage:double>>"
    parts: dict[bool, list[str]] = {True: [], False: []}
    for (label, words, (low, high), exact), at in zip(known, chosen, strict=True):
        parts[exact].append(_found(label, [code[w] for w in words], low, high, at, 1.0 if exact else COVERAGE))
    every = lambda e: F.expr(f"if(size(anchored) > 0, cast(concat({', '.join(parts[e])}) as {kind}), cast(array() as {kind}))")
    return df.select("id", "n_words", every(True).alias("base"), every(False).alias("found"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    label = lambda c: F.transform(c, lambda x: x["label"])
    start = lambda c: F.transform(c, lambda x: x["start"].cast("long"))
    joined = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(start("base")).alias("first_word"), F.array_max(start("base")).alias("last_word"),
        joined(label("base")).alias("base_labels"), joined(F.concat(label("base"), label("found"))).alias("labels"),
        F.coalesce(F.array_max(F.transform(F.concat("base", "found"), lambda x: x["coverage"])), F.lit(0.0)).alias("score"),
    )
