"""Line-first cleaning: judge each line, remove failures, then judge what is left.

A line fails by one of four rules, looked at in this order:

- boilerplate: holds one of the phrases of `Rules.boilerplate` (A-Z lower-cased);
- navigation: at least `nav_marks` characters of `|` `<` `>`, and one for every
  `nav_words` words or fewer;
- symbols: as many characters of `[#*$%&|<>]` as words, or more;
- punctuation: no character of `enders` within its last three bytes that are not
  blanks, and fewer than `short_words` words: a heading, a menu entry, a caption.

A text loses its failed lines. It is rejected if the words lost are more than
`max_lost_percent` of its words, or if the whole text fails the base test (fewer
than 50 words, or over half of them in 3-word windows that occur twice).

Defined cases: null text has no word, so it fails the base test, and its cleaned
text is null; an empty text likewise with an empty one; lines of blanks alone are
kept and have no words; repeated rows give repeated result rows; an empty table
gives an empty result; further columns of the input are not read.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stormledger.llm import texts

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
MARKS = np.isin(np.arange(256), np.frombuffer(b"|<>", dtype=np.uint8))
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclasses.dataclass(frozen=True)
class Rules:
    """Parameters of the line rules."""

    boilerplate: tuple[str, ...] = (
        "all rights reserved", "privacy policy", "terms of service", "terms of use", "cookie policy",
        "accept cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our",
        "sign up for", "powered by", "copyright (c)", "skip to content",
        "tous droits réservés", "politique de confidentialité", "mentions légales", "accepter les cookies", "activer javascript",
        "alle rechte vorbehalten", "datenschutzerklärung", "allgemeine geschäftsbedingungen", "cookies akzeptieren", "zum inhalt springen",
        "todos los derechos reservados", "política de privacidad", "política de cookies", "aceptar cookies", "saltar al contenido",
    )
    nav_marks: int = 3
    nav_words: int = 4
    enders: str = ".!?:;\"')]}…”»’。！？：；」』）｡।॥؟؛۔።"
    short_words: int = 4
    max_lost_percent: int = 40


def _contains(lowered: bytes, phrase: bytes, starts: np.ndarray, failed: np.ndarray) -> None:
    """Mark the lines in which a phrase begins; no phrase holds a line feed."""
    at = lowered.find(phrase)
    while at >= 0:
        failed[np.searchsorted(starts, at, "right") - 1] = True
        at = lowered.find(phrase, at + 1)


def _ends_well(data: np.ndarray, lines: texts.Spans, enders: str) -> np.ndarray:
    """Lines whose last three bytes but blanks hold one of the closing characters."""
    out = np.zeros(len(lines), dtype=bool)
    solid = np.flatnonzero(~texts.blanks(data))
    last = np.searchsorted(solid, lines.ends)
    first = np.searchsorted(solid, lines.starts)
    single = np.isin(np.arange(256), [ord(c) for c in enders if ord(c) < 128])
    for back in (1, 2, 3):
        at = last - back
        have = at >= first
        out[have] |= single[data[solid[at[have]]]]
    # characters of three bytes: compare the last three bytes of the line
    for c in (c.encode() for c in enders if ord(c) >= 128):
        have = last - len(c) >= first
        same = have.copy()
        for k, byte in enumerate(c):
            same[have] &= data[solid[last[have] - len(c) + k]] == byte
        out |= same
    return out


def judge(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """Counts and verdicts of each text, and which of its lines stay."""
    data, offsets = texts.raw(column)
    n = len(offsets) - 1
    blank = texts.blanks(data)
    words = texts.words(data, offsets, blank)
    lines = texts.lines(data, offsets)
    line_of_word = np.searchsorted(lines.starts, words.starts, "right") - 1
    # of lines that start at the same byte (an empty one at a text's end) the last holds the word
    n_in_line = np.bincount(line_of_word, minlength=len(lines)) if len(words) else np.zeros(len(lines), dtype=np.int64)

    n_words = words.per_row()
    solid = texts.sums_between(~blank & ((data & 0xC0) != 0x80), offsets[:-1], offsets[1:])
    n_symbols = texts.sums_between(SYMBOLS[data], offsets[:-1], offsets[1:])

    full = np.flatnonzero(n_in_line > 0)
    key = texts.span_hashes(data, lines.starts[full], lines.ends[full])
    order = np.lexsort((key, lines.rows[full]))
    again = (key[order][1:] == key[order][:-1]) & (lines.rows[full][order][1:] == lines.rows[full][order][:-1])
    n_dup = np.bincount(lines.rows[full][order][1:][again], minlength=n)

    covered = np.zeros(len(words) + 1, dtype=np.int64)
    three, first = texts.windows(words.hashes(), words.rows, 3)
    if len(three):
        order = np.lexsort((three, words.rows[first]))
        same = (three[order][1:] == three[order][:-1]) & (words.rows[first][order][1:] == words.rows[first][order][:-1])
        twice = np.zeros(len(three), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(covered, first[twice], 1)
        np.add.at(covered, np.minimum(first[twice] + 3, len(words)), -1)
    n_repeat = np.bincount(words.rows, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)

    failed = np.zeros(len(lines), dtype=bool)
    lowered = texts.LOWER[data].tobytes()
    for phrase in rules.boilerplate:
        _contains(lowered, phrase.encode(), lines.starts, failed)
    marks = texts.sums_between(MARKS[data], lines.starts, lines.ends)
    symbols = texts.sums_between(SYMBOLS[data], lines.starts, lines.ends)
    failed |= (marks >= rules.nav_marks) & (marks * rules.nav_words >= n_in_line)
    failed |= (n_in_line > 0) & (symbols >= n_in_line)
    failed |= (n_in_line > 0) & (n_in_line < rules.short_words) & ~_ends_well(data, lines, rules.enders)
    lost = np.bincount(lines.rows[failed], weights=n_in_line[failed], minlength=n).astype(np.int64)

    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    return {
        "n_words": n_words, "word_chars": solid, "n_symbols": n_symbols, "n_dup_lines": n_dup.astype(np.int64),
        "n_repeat_words": n_repeat, "base_failed": base_failed,
        "kept": ~base_failed & (100 * lost <= rules.max_lost_percent * n_words),
        "n_lost_words": lost, "n_lost_lines": np.bincount(lines.rows[failed], minlength=n).astype(np.int64),
        "_failed": failed, "_lines": lines,
    }


def _cleaned(column: pa.Array, found: dict) -> pa.Array:
    """Texts without their failed lines; the line feed after a removed line goes as well."""
    lines, failed = found["_lines"], found["_failed"]
    if not failed.any():
        return column
    body, out = lines.data.tobytes(), []
    edges = lines.edges()
    for row in range(lines.n_rows):
        if not column[row].is_valid:
            out.append(None)
            continue
        stay = [k for k in range(edges[row], edges[row + 1]) if not failed[k]]
        out.append(b"\n".join(body[lines.starts[k]:lines.ends[k]] for k in stay).decode())
    return pa.array(out, pa.string())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICTS = ("base_failed", "kept")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict of every text."""
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(part.column("text"), rules)
        names = [*COUNTS, *VERDICTS, "n_lost_words", "n_lost_lines"]
        return pa.RecordBatch.from_arrays([part.column("key"), *(pa.array(found[c]) for c in names)], ["key", *names])

    kind = docs.schema[key].dataType.simpleString()
    columns = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} boolean" for c in VERDICTS), "n_lost_words long, n_lost_lines long"])
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return texts.map_texts(rows, work, f"key {kind}, {columns}").withColumnRenamed("key", key)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Kept documents with their cleaned text, as (key, text)."""
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(part.column("text"), rules)
        batch = pa.RecordBatch.from_arrays([part.column("key"), _cleaned(part.column("text"), found).cast(pa.string())], ["key", "text"])
        return batch.filter(pa.array(found["kept"]))

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return texts.map_texts(rows, work, f"key {kind}, text string").toDF(key, text)
