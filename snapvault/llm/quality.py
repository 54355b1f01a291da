"""Line-first cleaning and document quality rules.

Every line is judged first: too many symbols, shouting, navigation (cells
between separators) or a boilerplate phrase make it fail.  Failed lines are
removed; a document that loses more than ``max_lost`` of its words is
rejected.  Base rules on the whole text (number of words, repeated five-word
windows) come before the verdict.

Words are runs of other than ASCII white space, lines are parted by ``\\n``;
lines without a word are neither judged nor counted.  Null text has no words;
an empty table gives no rows; repeated rows are judged one by one; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, text_hash, utf8

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10     # symbols against the line's bytes that are no white space
MAX_SHOUT_PERCENT = 50      # words that end in !! or ?? against the line's words
MIN_SEPARATORS = 3          # lone | » · in a line of any length
MIN_CELLS = 2               # lone separators of any kind in a line of few words
MIN_CELL_PERCENT = 25       # those separators against the line's words
MAX_LOST_PERCENT = 30
#: Fixed phrases of page furniture, in lower case.
BOILERPLATE = (b"all rights reserved", b"cookie policy", b"privacy policy", b"terms of use", b"terms of service",
               b"click here", b"enable javascript", b"lorem ipsum", b"skip to content", b"sign up for our newsletter")
SEPARATORS = (b"|", "»".encode(), "·".encode())
CELL_SEPARATORS = frozenset((*SEPARATORS, b"/", "•".encode(), "›".encode(), "→".encode()))
RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, n_failed_lines long, n_lost_words long, kept boolean, text_hash long")
_TO_SYMBOL = bytes(i for i in range(256) if i not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """One line's verdict; ``words`` are its words."""
    n_bytes = sum(map(len, words))
    if 100 * len(line.translate(None, _TO_SYMBOL)) > MAX_SYMBOL_PERCENT * n_bytes:
        return True
    if b"!!" in line or b"??" in line:
        loud = sum(w.endswith((b"!!", b"??")) for w in words)
        if 100 * loud > MAX_SHOUT_PERCENT * len(words):
            return True
    if any(s in line for s in CELL_SEPARATORS):
        if sum(w in SEPARATORS for w in words) >= MIN_SEPARATORS:
            return True
        cells = sum(w in CELL_SEPARATORS for w in words)
        if cells >= MIN_CELLS and 100 * cells >= MIN_CELL_PERCENT * len(words):
            return True
    low = line.lower()
    return any(p in low for p in BOILERPLATE)


def clean_lines(body: bytes) -> tuple[bytes, int, int, int]:
    """(text without its failed lines, failed lines, words lost, repeats of earlier lines)."""
    kept, seen, failed, lost, dup = [], set(), 0, 0, 0
    for line in body.split(b"\n"):
        words = line.split()
        if not words:
            kept.append(line)
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        if line_fails(line, words):
            failed += 1
            lost += len(words)
        else:
            kept.append(line)
    return b"\n".join(kept), failed, lost, dup


def repeat_words(counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each text, words inside a five-word window that the text has twice or more.

    ``ids``: the texts' words as numbers, ``counts``: words of each text.
    Windows are equal when their five numbers are: the numbers are combined
    pair by pair into ranks, so no two windows share one by chance.
    """
    n, out = len(ids), np.zeros(len(counts), np.int64)
    if n < WINDOW:
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    if not len(starts):
        return out
    # a 64-bit mix orders the windows; equal mixes are then compared word by word
    mix = doc[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words = ids.astype(np.uint64)
    for k in range(WINDOW):
        mix = (mix ^ (words[starts + k] + np.uint64(0x632BE59BD9B4E019))) * np.uint64(0xD6E8FEB86659FD93)
        mix ^= mix >> np.uint64(32)
    order = np.argsort(mix, kind="stable")
    same = np.flatnonzero(mix[order[1:]] == mix[order[:-1]])
    if not len(same):
        return out
    # runs of equal mixes: group by their true content
    runs = np.unique(np.concatenate([order[same], order[same + 1]]))
    content = np.stack([doc[starts[runs]]] + [ids[starts[runs] + k] for k in range(WINDOW)], axis=1)
    _, group, size = np.unique(content, axis=0, return_inverse=True, return_counts=True)
    twice = starts[runs[size[group.ravel()] >= 2]]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, np.minimum(twice + WINDOW, n), -1)
    covered = np.cumsum(mark)[:n] > 0
    return np.bincount(doc[covered], minlength=len(counts)).astype(np.int64)


def _judge(batches):
    for batch in batches:
        bodies = batch.column("body").to_pylist()
        number: dict = {}
        split = [b.split() for b in bodies]
        counts = np.array([len(w) for w in split], np.int64)
        ids = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, counts.sum())
        repeats = repeat_words(counts, ids)
        chars = [len(b"".join(w).translate(None, _CONTINUATION)) for w in split]
        del split, number
        symbols = [len(b.translate(None, _TO_SYMBOL)) for b in bodies]
        lines = [clean_lines(b)[1:] for b in bodies]
        failed, lost, dup = (np.array(x, np.int64) for x in zip(*lines)) if lines else (np.zeros(0, np.int64),) * 3
        base = (counts < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * counts)
        kept = ~base & (100 * lost <= MAX_LOST_PERCENT * counts)
        cols = [batch.column("doc_id"), counts, chars, symbols, dup, repeats, base, failed, lost, kept,
                batch.column("text_hash")]
        names = [x.split()[0] for x in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, ``base_failed``, lines and words lost, ``kept``."""
    arrow_limits(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(f"`{text_col}`").alias("body"),
                       text_hash(f"`{text_col}`").alias("text_hash")).mapInArrow(_judge, RESULT)


def cleaned_text(text: Column) -> Column:
    """The text without its failed lines (null stays null)."""
    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else clean_lines(x.encode("utf-8", "replace"))[0].decode())

    return clean(text)
