"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Pieces and log scores come from a SentencePiece model file; nothing is
trained.  Space is the white-space marker, and one is put before a text that
is not empty.  Characters without a piece cost the unknown score and leave as
byte pieces.  The trie's byte transitions sit in two arrays (``base`` and
``check``), walked for all start positions of a batch at once; the Viterbi
step then goes through the batch's units side by side, one start offset at a
time, and keeps the earliest of equal scores.

No piece holds a marker after another character, nor a line break, so texts
part there into units whose best segmentations are independent; a bounded
memory of units serves repeated words.

Cases: null text equals empty text (no pieces, decodes to the empty text);
a literal U+2581 is kept apart from the marker by its byte pieces, so decoding
gives every text back; repeated rows are encoded one by one; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from snapvault.llm.common import arrow_limits, by_bytes, remembered, utf8

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_UNITS = 350_000
#: A unit: markers (held as spaces) and what follows them, or a line break.
UNIT = rb" *[^ \n]+| +|\n"


def fields(data: bytes):
    """(number, wire type, value) of each field of a protocol-buffer message."""
    i = 0

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, wire, varint()
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            yield number, wire, data[i:i + n]
            i += n
        elif wire == 2:
            n = varint()
            yield number, wire, data[i:i + n]
            i += n
        else:
            raise ValueError(f"wire type {wire}")


class UnigramModel:
    """Pieces, scores and the double array; plain arrays, so tasks get it as a broadcast."""

    def __init__(self, model: bytes):
        self.pieces, scores, kinds, trained_as = [], [], [], 1
        for number, _, value in fields(model):
            if number == 1:  # a piece: text 1, score 2, type 3 (1 normal, 2 unknown, 3 control, 4 user, 6 byte)
                text, score, kind = b"", 0.0, 1
                for n, _, v in fields(value):
                    if n == 1:
                        text = v
                    elif n == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif n == 3:
                        kind = v
                self.pieces.append(text)
                scores.append(score)
                kinds.append(kind)
            elif number == 2:  # how the file was trained; field 3: 1 unigram, 2 BPE
                trained_as = next((v for n, _, v in fields(value) if n == 3), 1)
        if trained_as == 2:
            # a BPE file's scores are minus the merge rank; by Zipf's law a piece of rank r has probability
            # 1 / (r + 1) over their sum, whose logarithm is the piece's log score
            total = np.log(sum(1.0 / (1.0 - s) for s, kind in zip(scores, kinds) if kind == 1))
            scores = [-float(np.log(1.0 - s) + total) if kind == 1 else s for s, kind in zip(scores, kinds)]
        self.score = np.array(scores, np.float64)
        self.byte_id = np.full(256, -1, np.int32)
        self.raw: list[bytes] = []  # what each piece decodes to
        words = {}
        for k, (text, kind) in enumerate(zip(self.pieces, kinds)):
            raw = text.replace(MARKER.encode(), b" ")
            if kind == 6:
                value = int(text[3:5], 16)
                self.byte_id[value] = k
                raw = bytes([value])
            elif kind in (1, 4):
                words[raw] = k
            else:
                raw = b""
            self.raw.append(raw)
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        if any(b" " in w.lstrip(b" ") or b"\n" in w for w in words):
            raise ValueError("a piece crosses a unit's end")
        normal = [s for s, kind in zip(scores, kinds) if kind == 1]
        self.unknown = (min(normal) if normal else 0.0) - UNKNOWN_PENALTY
        self._build(words)

    def _build(self, words: dict[bytes, int]) -> None:
        """First-fit double array, nodes with most children first within a level."""
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for w, k in words.items():
            node = 0
            for b in w:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = k
        size = 4 * len(children) + 4096
        base, check, item = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        place, level, low = {0: 0}, [0], 1
        while level:
            following = []
            for node in sorted(level, key=lambda n: -len(children[n])):
                kids = children[node]
                if not kids:
                    continue
                codes = np.array(sorted(kids))
                at, gaps, wide = max(low, int(codes[0]) + 1), codes - codes[0], 256
                while True:
                    if at + wide + 256 > len(free):
                        more = len(free)
                        base, check, item, free = (np.concatenate([x, np.full(more, f, x.dtype)]) for x, f in (
                            (base, 0), (check, -1), (item, -1), (free, True)))
                    fits = free[at:at + wide].copy()
                    for g in gaps[1:]:
                        fits &= free[at + g:at + g + wide]
                    first = int(fits.argmax())
                    if fits[first]:
                        at += first
                        break
                    at, wide = at + wide, min(2 * wide, 8192)
                b, here = at - int(codes[0]), place[node]
                base[here] = b
                free[b + codes] = False
                check[b + codes] = here
                for c in codes.tolist():
                    place[kids[c]] = b + c
                    item[b + c] = value[kids[c]]
                following.extend(kids.values())
                # leave a stretch that is nearly full behind
                while not free[low:low + 64].any() or (at > low + 4096 and free[low:low + 1024].sum() < 50):
                    low += 64
            level = following
        self.base, self.check, self.item = base, check, item

    def matches(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(start position, end position, piece) of every piece found; walks all starts side by side."""
        state = np.zeros(len(starts), np.int64)
        origin, pos, stop = starts, starts.copy(), ends
        found = []
        while True:
            live = pos < stop
            state, origin, pos, stop = state[live], origin[live], pos[live], stop[live]
            if not len(pos):
                break
            to = self.base[state] + buf[pos].astype(np.int64)
            ok = (to < len(self.check)) & (to > 0)
            to = np.where(ok, to, 0)
            ok &= self.check[to] == state
            state, origin, pos, stop = to[ok], origin[ok], pos[ok] + 1, stop[ok]
            piece = self.item[state]
            hit = piece >= 0
            found.append((origin[hit], pos[hit], piece[hit]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def segment(self, units: list[bytes]) -> list[bytes]:
        """Best pieces of each unit (none of them empty), as int32 bytes."""
        n = len(units)
        size = np.fromiter(map(len, units), np.int64, n)
        buf = np.frombuffer(b"".join(units), np.uint8)
        end = np.cumsum(size)
        start = end - size
        lead = np.flatnonzero((buf & 0xC0) != 0x80)  # where characters start
        unit_of = np.repeat(np.arange(n), size)
        s, e, piece = self.matches(buf, lead, end[unit_of[lead]])
        # characters without a piece of their own: one unknown edge
        char_end = np.r_[lead[1:], len(buf)]
        single = np.zeros(len(buf) + 1, bool)
        next_char = np.zeros(len(buf) + 1, np.int64)
        next_char[lead] = char_end
        single[s[e == next_char[s]]] = True
        lone = lead[~single[lead]]
        s, e = np.concatenate([s, lone]), np.concatenate([e, next_char[lone]])
        gain = np.concatenate([self.score[piece], np.full(len(lone), self.unknown)])
        piece = np.concatenate([piece, np.full(len(lone), -1, piece.dtype)])
        # cells: a unit of n bytes has n + 1, so that units don't touch
        cell0 = start + np.arange(n)
        owner = unit_of[s]
        rel = s - start[owner]
        a, z = cell0[owner] + rel, cell0[owner] + (e - start[owner])
        order = np.argsort(rel, kind="stable")
        a, z, gain, piece, rel = a[order], z[order], gain[order], piece[order], rel[order]
        best = np.full(len(buf) + n, -np.inf)
        best[cell0] = 0.0
        back = np.full(len(buf) + n, -1, np.int64)
        cuts = np.flatnonzero(np.r_[True, rel[1:] != rel[:-1]]).tolist() + [len(rel)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            # one start a unit, so no two edges here share an end
            total = best[a[x:y]] + gain[x:y]
            to = z[x:y]
            better = total > best[to]
            best[to[better]] = total[better]
            back[to[better]] = np.arange(x, y)[better]
        out_unit, out_piece, out_step = [], [], []
        at, who, step = cell0 + size, np.arange(n), 0
        while len(at):
            edge = back[at]
            lost = piece[edge] < 0
            keep = np.flatnonzero(~lost)
            out_unit.append(who[keep])
            out_piece.append(piece[edge[keep]])
            out_step.append(np.full(len(keep), step))
            for k in np.flatnonzero(lost).tolist():  # byte fallback, last byte first
                w = who[k]
                lo, hi = a[edge[k]] - cell0[w] + start[w], z[edge[k]] - cell0[w] + start[w]
                ids = self.byte_id[buf[lo:hi]][::-1]
                out_unit.append(np.full(len(ids), w))
                out_piece.append(ids)
                out_step.append(step + np.arange(len(ids)) / 8)
            at = a[edge]
            more = at > cell0[who]
            at, who, step = at[more], who[more], step + 1
        u, p, t = np.concatenate(out_unit), np.concatenate(out_piece).astype(np.int32), np.concatenate(out_step)
        flat = p[np.lexsort((-t, u))].tobytes()
        cut = (4 * np.cumsum(np.bincount(u, minlength=n))).tolist()
        return [flat[x:y] for x, y in zip([0, *cut[:-1]], cut)]

    def decode(self, ids) -> str:
        """Text of piece ids: markers become spaces, byte pieces bytes; the marker put in front goes."""
        body = b"".join([self.raw[i] for i in ids])
        return body.removeprefix(b" ").decode("utf-8", "replace")


class Encoder:
    """Texts (UTF-8) -> piece ids as int32 bytes; the units' memory lives as long as the model in its process."""

    def __init__(self, model: UnigramModel):
        self.model, self.unit = model, re.compile(UNIT)

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        units = [self.unit.findall(b" " + b) if b else [] for b in bodies]
        now = set().union(*units)
        known = remembered(self.model, now, CACHE_UNITS)
        new = list(now.difference(known))
        for s, e in by_bytes(new, 1 << 20):
            known.update(zip(new[s:e], self.model.segment(new[s:e])))
        get = known.__getitem__
        return [b"".join(map(get, us)) for us in units]


def broadcast_model(spark, model: bytes):
    """The model in every executor; its size is the vocabulary's."""
    return spark.sparkContext.broadcast(UnigramModel(model))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "piece_ids",
           check_col: str | None = None) -> DataFrame:
    """``docs`` with the texts' piece ids in ``ids_col``; in ``check_col`` whether decoding them gives the text back.

    Columns of these names that ``docs`` has are replaced.
    """
    shared = broadcast_model(docs.sparkSession, model)
    arrow_limits(docs.sparkSession)
    carried = [f for f in docs.schema.fields if f.name not in (ids_col, check_col)]
    out = StructType([*carried, StructField(ids_col, ArrayType(IntegerType())),
                      *([StructField(check_col, BooleanType())] if check_col else [])])

    def run(batches):
        encoder = Encoder(shared.value)
        for b in batches:
            bodies = [(t or "").encode("utf-8", "replace") for t in b.column(text_col).to_pylist()]
            for s, e in by_bytes(bodies):
                flat = [np.frombuffer(x, np.int32) for x in encoder.encode(bodies[s:e])]
                ends = np.r_[0, np.cumsum([len(x) for x in flat])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat), pa.int32()))
                part = b.select([f.name for f in carried]).slice(s, e - s)
                cols, names = [*part.columns, lists], [*part.schema.names, ids_col]
                if check_col:
                    back = [shared.value.decode(x.tolist()).encode("utf-8") == y for x, y in zip(flat, bodies[s:e])]
                    cols, names = [*cols, pa.array(back, pa.bool_())], [*names, check_col]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, out)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids in ``text_col``, in place of a column of that name."""
    shared = broadcast_model(encoded.sparkSession, model)
    arrow_limits(encoded.sparkSession)
    carried = [f for f in encoded.schema.fields if f.name != text_col]
    out = StructType([*carried, StructField(text_col, StringType())])

    def run(batches):
        for b in batches:
            texts = [None if ids is None else shared.value.decode(ids) for ids in b.column(ids_col).to_pylist()]
            part = b.select([f.name for f in carried])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                             names=[*part.schema.names, text_col])

    return encoded.mapInArrow(run, out)


ROUND_TRIP = ("doc_id long, n_pieces long, n_byte_pieces long, pieces_sha256 string, text_sha256 string, "
              "decoded_sha256 string, round_trip boolean")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of pieces, digests of ids (little-endian int32), text and decoded text."""
    shared = broadcast_model(docs.sparkSession, model)
    arrow_limits(docs.sparkSession)

    def run(batches):
        m = shared.value
        encoder = Encoder(m)
        is_byte = np.zeros(len(m.pieces), bool)
        is_byte[m.byte_id] = True
        for b in batches:
            bodies = b.column("body").to_pylist()
            rows = []
            for s, e in by_bytes(bodies):
                for body, ids in zip(bodies[s:e], encoder.encode(bodies[s:e])):
                    array = np.frombuffer(ids, np.int32)
                    back = m.decode(array.tolist()).encode("utf-8")
                    rows.append((len(array), int(is_byte[array].sum()), hashlib.sha256(ids).hexdigest(),
                                 hashlib.sha256(body).hexdigest(), hashlib.sha256(back).hexdigest(), back == body))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=[x.split()[0] for x in ROUND_TRIP.split(", ")])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(f"`{text_col}`").alias("body"))
    return rows.mapInArrow(run, ROUND_TRIP)
