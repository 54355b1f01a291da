"""Token counts of a byte-level BPE tokenizer file, by rank-synchronous array merging.

Texts are cut at the file's special tokens (one token each, as the library
does by default) and then into units: a white-space run and the word after it.
No pre-token crosses a unit's end, so a unit's count holds wherever it stands.
The units that a batch sees for the first time become pre-tokens, held as one
ragged array of symbols.  Each step finds every pre-token's lowest-rank pair
and merges all its occurrences in all pre-tokens at once; the symbols that
survive when no pair has a rank are the tokens.

Cases: null text equals empty text (0 bytes, 0 tokens); whole texts of any
length; repeated rows are counted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, by_bytes, remembered

#: Unicode white space, and the split of the byte-level tokenizers.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PRE_TOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
             rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNIT = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
CACHE_UNITS = 500_000
_NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class MergeTable:
    """Ranks of symbol pairs as sorted arrays; plain arrays, so tasks get it as a broadcast."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pair = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        new = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank, self.new = pair[order], order.astype(np.int64), new[order]
        self.byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        if spec.get("normalizer") or spec["pre_tokenizer"].get("type") != "ByteLevel" or any(
                t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
            raise ValueError("only byte-level BPE without a normalizer and with plain added tokens")
        if spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("add_prefix_space is not supported")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or _NONE, merged symbol) of each pair."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = self.pair[at] == key
        return np.where(hit, self.rank[at], _NONE), self.new[at]

    def count(self, pre_tokens: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token (none of them empty)."""
        out = np.zeros(len(pre_tokens), np.int64)
        size = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        sym = self.byte[np.frombuffer(b"".join(pre_tokens), np.uint8)]
        which = np.repeat(np.arange(len(pre_tokens)), size)
        rank = np.full(len(sym), _NONE)
        new = np.zeros(len(sym), np.int64)
        inner = np.flatnonzero(which[1:] == which[:-1])
        rank[inner], new[inner] = self.look_up(sym[inner], sym[inner + 1])
        while len(sym):
            start = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            lowest = np.minimum.reduceat(rank, start)
            over = lowest == _NONE
            if over.any():  # finished sequences leave with their count
                out[which[start[over]]] = size[over]
                stay = np.repeat(~over, size)
                sym, which, rank, new = sym[stay], which[stay], rank[stay], new[stay]
                size, lowest = size[~over], lowest[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # of overlapping occurrences (one symbol repeated) every other one merges, from the left
            head = np.r_[True, np.diff(at) != 1]
            run = np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]
            at = at[run % 2 == 0]
            sym[at] = new[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # where the merged symbols are, once the others have gone
            sym, which, rank, new = sym[stay], which[stay], rank[stay], new[stay]
            mark = np.zeros(len(sym), bool)
            mark[at] = True
            mark[np.maximum(at, 1) - 1] = True
            changed = np.flatnonzero(mark)
            last = np.r_[which[1:] != which[:-1], True]
            rank[changed] = _NONE
            changed = changed[~last[changed]]
            rank[changed], new[changed] = self.look_up(sym[changed], sym[changed + 1])
        return out


def counter(table: MergeTable):
    """Texts -> token counts; the units' memory lives as long as the table in its process."""
    unit, pre = re.compile(UNIT), regex.compile(PRE_TOKEN)
    special = re.compile("|".join(map(re.escape, sorted(table.special, key=len, reverse=True)))
                         ) if table.special else None

    def learn(new: list[str], known: dict) -> None:
        parts = [pre.findall(u) for u in new]
        distinct = {p: k for k, p in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        tokens = table.count([p.encode("utf-8", "replace") for p in distinct]).tolist() if distinct else []
        for u, ps in zip(new, parts):
            known[u] = tokens[distinct[ps[0]]] if len(ps) == 1 else sum(tokens[distinct[p]] for p in ps)

    def count(texts: list[str]) -> list[int]:
        units, extra = [], []
        for t in texts:
            pieces = special.split(t) if special is not None and special.search(t) else [t]
            units.append([u for piece in pieces for u in unit.findall(piece)] if len(pieces) > 1 else unit.findall(t))
            extra.append(len(pieces) - 1)
        now = set().union(*units)
        known = remembered(table, now, CACHE_UNITS)
        new = list(now.difference(known))
        for at in range(0, len(new), 100_000):
            learn(new[at:at + 100_000], known)
        get = known.__getitem__
        return [sum(map(get, us)) + n for us, n in zip(units, extra)]

    return count


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. ``vocabulary``: a tokenizers .json file's text."""
    spark = docs.sparkSession
    arrow_limits(spark)
    table = spark.sparkContext.broadcast(MergeTable(vocabulary))  # bounded by the vocabulary file

    def run(batches):
        count = counter(table.value)
        for b in batches:
            texts = b.column("text").to_pylist()
            n = [x for s, e in by_bytes(texts) for x in count(texts[s:e])]
            size = [len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
