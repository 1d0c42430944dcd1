"""Quality rules, line first: each line is judged by punctuation, navigation, symbol, case, repetition and boilerplate
rules, failing lines go, and a document that loses too much of its text is rejected.

One pass over the texts, no shuffle: a struct column computed from Arrow batches, so every other column of the input
passes by untouched and clashing names cannot occur.

Defined cases: a null text has no words and is judged like an empty one (base_failed, not kept, clean text empty);
repeated rows are judged alike, each by itself; an empty table gives an empty result; very long texts are processed
whole, as a run of their own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, byte_codes, free_name, runs_of_text, space_words

#: Below so many words a document fails; so do documents of which more than 30 % of the words lie in repeated windows.
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
#: A document is rejected when less than this share of its word characters is on lines that pass.
MIN_KEPT = 0.5
#: Phrases that mark a short line as boilerplate (fixed values).
BOILERPLATE = re.compile(
    r"all rights reserved|privacy policy|cookie policy|uses? cookies|accept cookies|terms of (?:use|service)|"
    r"enable javascript|click here|sign (?:in|up)|log ?in to|subscribe to|share (?:this|on)|read more|lorem ipsum|"
    r"skip to content|back to top|"
    r"alle rechte vorbehalten|datenschutz(?:erklärung|richtlinie)|nutzungsbedingungen|hier klicken|jetzt anmelden|zum inhalt springen|"
    r"nach oben|weiterlesen|verwendet cookies|"
    r"tous droits réservés|politique de confidentialité|conditions d'utilisation|cliquez ici|se connecter|lire la suite|"
    r"aller au contenu|utilise des cookies|"
    r"todos los derechos reservados|política de privacidad|términos de uso|haga clic aquí|iniciar sesión|leer más|"
    r"saltar al contenido|utiliza cookies",
    re.I,
)
BOILERPLATE_WORDS = 15
_ENDS = tuple(".!?:;…。！？।\"'”’»)]")
_NAVIGATION = re.compile(r"[|»›•·→]|(?<=\s)>(?=\s)")
_SYMBOLS = re.compile(r"[#*$%&|<>{}~^=_\\@]")

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_lines long, n_lines_removed long, kept_chars long, kept boolean, clean_text string"
)


def line_fails(line: str) -> str | None:
    """The rule that a line fails, or None. A blank line fails none."""
    words = line.split()
    if not words:
        return None
    n, chars = len(words), sum(map(len, words))
    if n <= BOILERPLATE_WORDS and BOILERPLATE.search(line):
        return "boilerplate"
    bars = len(_NAVIGATION.findall(line))
    if bars >= 3 and 4 * bars >= n - bars:
        return "navigation"
    if 10 * len(_SYMBOLS.findall(line)) > chars:
        return "symbols"
    if n >= 10 and 4 * len(set(words)) <= n:
        return "repetition"
    if n >= 5:
        upper = sum(map(str.isupper, line))
        if upper and 10 * upper > 7 * sum(map(str.isalpha, line)):
            return "case"
    if not words[-1].endswith(_ENDS) and n < 3:
        return "punctuation"
    if n >= 30 and not re.search(r"[.!?,;:…。！？、，।]", line):
        return "punctuation"
    return None


def _repeated(grams: np.ndarray, n_words: int) -> int:
    """Words in windows that occur twice or more."""
    if len(grams) < 2:
        return 0
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(grams, twice)
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:n_words] > 0).sum())


def _judge(texts: pa.Array) -> pa.Array:
    inside = space_words()
    codes = byte_codes(False, inside)
    symbol = np.zeros(256, np.int64)
    symbol[[ord(c) for c in "#*$%&|<>"]] = 1
    lead = np.where((np.arange(256) & 0xC0) != 0x80, 1, 0)
    out: dict[str, list] = {f.split()[0]: [] for f in SCHEMA.split(", ")}
    for low, high, data, offsets in runs_of_text(texts):
        w = Words(data, offsets, inside, codes)
        grams = w.grams(WINDOW)
        total = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])
        n_words, chars, symbols = np.diff(w.first), total(lead * inside), total(symbol)
        for i in range(high - low):
            a, n = int(w.first[i]), int(n_words[i])
            repeat = _repeated(grams[a : a + n - WINDOW + 1], n) if n > WINDOW else 0
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            lines = text.split("\n")
            seen: set[str] = set()
            dup = removed = kept_chars = 0
            kept_lines = []
            for line in lines:
                worded = line.strip(" \t\n\x0b\x0c\r")
                if worded:
                    dup += line in seen
                    seen.add(line)
                if worded and line_fails(line):
                    removed += 1
                else:
                    kept_lines.append(line)
                    kept_chars += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
            failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
            row = (n, int(chars[i]), int(symbols[i]), dup, repeat, failed, len(lines), removed, kept_chars)
            row += (not failed and kept_chars >= MIN_KEPT * int(chars[i]), "\n".join(kept_lines))
            for column, x in zip(out.values(), row, strict=True):
                column.append(x)
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[f.split()[1]] for f in SCHEMA.split(", ")]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(out.values(), types, strict=True)], list(out))


def quality(text: Column | str) -> Column:
    """Struct (SCHEMA) of a text's measures, verdict and cleaned text."""

    @F.arrow_udf(f"struct<{', '.join(x.replace(' ', ':') for x in SCHEMA.split(', '))}>")
    def judge(texts: pa.Array) -> pa.Array:
        return _judge(texts)

    return judge(text)


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns unchanged, whose text is kept."""
    return df.where(quality(F.col(text_col)).getField("kept"))


def cleaned(df: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """As `keep_good`, with failing lines taken out of the texts, and the length of a changed text in `n_chars_col`."""
    q = free_name(df, "_quality_")
    judged = df.withColumn(q, quality(F.col(text_col))).where(F.col(f"{q}.kept"))
    changed = F.col(f"{q}.n_lines_removed") > 0
    new = {text_col: F.when(changed, F.col(f"{q}.clean_text")).otherwise(F.col(text_col))}
    if n_chars_col in df.columns:
        new[n_chars_col] = F.when(changed, F.char_length(f"{q}.clean_text")).otherwise(F.col(n_chars_col)).cast(dict(df.dtypes)[n_chars_col])
    return judged.select(*(new[c].alias(c) if c in new else F.col(c) for c in df.columns))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", quality(F.col("text")).alias("q"))
    return docs.select(
        "doc_id", *(f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed", "kept_chars")),
        F.sha2("q.clean_text", 256).alias("clean_sha256"),
    )
