"""SentencePiece encoding of merge-type (BPE) models by backtracking.

A sequence of pieces is the model's encoding of a text exactly if every piece
is what merging its own characters gives, and every two neighbours stay apart
when the characters of both are merged anew.  So no merge is replayed over the
text; it is covered from left to right:

* an Aho-Corasick automaton over the pieces gives the longest one that starts
  at a place; shorter ones are its prefixes that are pieces too;
* a piece is taken if it is compatible with its left neighbour: merging both
  again must give both.  The last merges of the two are undone step by step, and
  none across the border may have come before one that is undone.  Verdicts are
  kept, pairs of neighbours repeat;
* where no piece fits, the place is marked in a bitfield of failed positions,
  which no later attempt enters again, and the last piece is replaced by a
  shorter one.  Each place fails once at most, so the work is linear in the text.

A character that is no piece stands for itself and ends as byte pieces.  A text
is cut where no piece can reach across, as before a word mark, and each distinct
word is covered once while a task keeps it.  Nothing is shuffled; a lost task is
simply run again.
"""

from __future__ import annotations

import gc
import math
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import append

#: Encoded words and verdicts on neighbours that a task keeps; beyond, it forgets them.
CACHED_WORDS = 600_000
CACHED_PAIRS = 1_000_000
#: Longer words are covered whenever they occur.
LONGEST_CACHED = 64
MARK = "▁"
# Fixed values of the model format: the types of a piece.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
ENCODED = StructType([StructField("ids", ArrayType(IntegerType(), False), False),
                      StructField("decoded", StringType(), False)])


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[at:at + size]
        at += size


def load_model(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id, from the content of a model file.

    Only what this operator encodes exactly is accepted: a BPE model with byte
    pieces and identity normalisation that adds a word mark in front.
    """
    pieces, bpe, rule = [], False, {}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own[1].decode(), score, own.get(3, NORMAL)))
        elif number == 2:
            bpe = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            rule = dict(_fields(value))
    plain = not rule.get(2) and rule.get(3, 1) and not rule.get(4, 1) and rule.get(5, 1)
    kinds = {kind for _, _, kind in pieces}
    crossing = any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind == NORMAL)
    if not (bpe and plain and BYTE in kinds and kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}) or crossing:
        raise ValueError("not a BPE model with byte pieces, marks in front of words and identity normalisation")
    return pieces


class Remerge:
    """The model's own rule on short strings: of all neighbours whose text is a
    piece the best score merges first, of equal ones the leftmost."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.score = {p: score for p, score, kind in pieces if kind == NORMAL}

    def __call__(self, text: str, until: int = 1) -> list[str]:
        """The parts of a text when no merge is left, or ``until`` are left."""
        score, parts = self.score.get, list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def last_merges(self) -> dict[str, str | None]:
        """For each piece that merging can give at all, the first of the two parts
        of its last merge; none where a part scores no better than the piece, so
        that the order of scores doesn't tell the order of merges."""
        found: dict[str, str | None] = {}
        for p, own in self.score.items():
            parts = self(p, 2)
            if len(self(p)) == 1:
                later = all(len(x) == 1 or self.score[x] > own for x in parts)
                found[p] = parts[0] if len(p) > 1 and later else None
        return found


class Backtracking:
    """Covers strings by pieces; made once a task."""

    def __init__(self, pieces: list[tuple[str, float, int]], last: dict[str, str | None]):
        self.remerge = Remerge(pieces)
        self.automaton = ahocorasick.Automaton()
        for p in last:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.last = last
        self.verdicts: dict[tuple[str, str], bool] = {}

    def compatible(self, left: str, right: str) -> bool:
        """Do the two stay apart when their characters are merged anew?"""
        verdict = self.verdicts.get((left, right))
        if verdict is None:
            if len(self.verdicts) >= CACHED_PAIRS:
                self.verdicts.clear()
            verdict = self.verdicts[left, right] = self.apart(left, right)
        return verdict

    def apart(self, left: str, right: str) -> bool:
        """The last merges undone: a merge across the border must not come first.
        Of equal scores it comes before one to its right, and after one to its left."""
        score, last, whole = self.remerge.score, self.last, (left, right)
        limit, also = -math.inf, False
        while True:
            s = score.get(left + right, -math.inf)
            if s > limit or also and s == limit:
                return False
            a = score[left] if len(left) > 1 else math.inf
            b = score[right] if len(right) > 1 else math.inf
            if a == b == math.inf:
                return True
            cut = last[left if a < b else right]
            if cut is None:  # merge all characters instead
                return self.remerge("".join(whole)) == [*whole]
            limit, also = min(a, b), a >= b
            if a < b:
                left = left[len(cut):]
            else:
                right = cut

    def shorter(self, piece: str) -> str | None:
        """The next shorter piece, or else character, that a piece starts with."""
        last = self.last
        for size in range(len(piece) - 1, 1, -1):
            if piece[:size] in last:
                return piece[:size]
        return piece[0] if len(piece) > 1 else None

    def cover(self, text: str) -> list[str]:
        """The pieces of a text."""
        if text in self.last:
            return [text]
        out: list[str] = []
        before, at, n = "", 0, len(text)
        verdict, longest = self.verdicts.get, self.automaton.iter_long
        failed = bytearray((n >> 3) + 1)
        matches, resume = longest(text), 0
        while at < n:
            if at != resume:
                matches = longest(text, at)
            last, piece = next(matches, (n, ""))
            resume = last + 1
            if resume - len(piece) != at:  # no piece starts here
                piece, resume = text[at], -1
            while True:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = not before or verdict((before, piece))
                    if fits or fits is None and self.compatible(before, piece):
                        break
                piece = self.shorter(piece)
                while piece is None:  # the place fails; a shorter piece before it may do
                    failed[at >> 3] |= 1 << (at & 7)
                    dropped = out.pop()
                    before = out[-1] if out else ""
                    at -= len(dropped)
                    piece = self.shorter(dropped)
            out.append(piece)
            before, at = piece, end
        return out


def _cutter(pieces: Iterable[str]) -> re.Pattern:
    """Cuts a text at places that no piece spans, so no merge does: before a word
    mark that follows another character, around characters that are in no longer
    piece, and behind a letter that no letter follows, if no piece goes on there."""
    longer = [p for p in pieces if len(p) > 1]
    joined = {c for p in longer for c in p} - {MARK}
    ends = not any(a.isalpha() and not b.isalpha() for p in longer for a, b in zip(p, p[1:]))
    letters = {c for c in joined if ends and c.isalpha()}
    some, rest = ("".join(map(re.escape, sorted(x))) for x in (letters, joined - letters))
    word = f"[{rest}]*[{some}]+|{MARK}*[{rest}]+" if some else f"[{rest}]+"
    return re.compile(f"{MARK}*{word}|{MARK}+|[^{MARK}{some}{rest}]")


class Encoder:
    """Encodes and decodes batches of texts; made once a task."""

    def __init__(self, pieces: list[tuple[str, float, int]], last: dict[str, str | None]):
        self.search = Backtracking(pieces, last)
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.words: dict[str, bytes] = {}  # a word's ids, as 32-bit integers
        self.cut = _cutter(self.ids).findall
        self.raw = [b"" if kind == CONTROL else b" \xe2\x81\x87 " if kind == UNKNOWN
                    else bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode()
                    for p, _, kind in pieces]
        self.bytes = frozenset(self.byte.values())
        self.marked = {i for p, i in self.ids.items() if p.startswith(MARK)}
        self.silent = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.types = to_arrow_type(ENCODED["ids"].dataType), pa.string()

    def word(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.search.cover(text):
            found = self.ids.get(piece)
            ids += (found,) if found is not None else (self.byte[b] for b in piece.encode())
        return array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        words = [self.cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        long: dict[str, bytes] = {}
        for w in set(chain.from_iterable(words)).difference(known):
            (known if len(w) <= LONGEST_CACHED else long)[w] = self.word(w)
        find = known.__getitem__ if not long else lambda w: known[w] if w in known else long[w]
        return [np.frombuffer(b"".join(map(find, own)), np.int32) for own in words]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: the mark in front is dropped, bytes that are no
        character become U+FFFD, control ids are silent."""
        data = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if i not in self.silent), None)
        if first in self.marked:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._mended(ids, first)

    def _mended(self, ids: list[int], first: int | None) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                del run[:size]

        for i in ids:
            if i in self.bytes:
                run += self.raw[i]
            else:
                flush()
                out.append(self.raw[i].decode())
        flush()
        text = "".join(out)
        return text[1:] if first in self.marked else text

    def run(self, texts: list) -> pa.Array:
        # Nothing here refers to itself; the collector would only walk the caches again and again.
        gc.disable()
        try:
            ids = self.encode([t or "" for t in texts])
            texts = [self.decode(own.tolist()) for own in ids]
        finally:
            gc.enable()
        offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, np.concatenate(ids), type=self.types[0]), pa.array(texts, self.types[1])],
            fields=list(to_arrow_type(ENCODED)))


def encode_decode(docs: DataFrame, model_file: bytes, text: str = "text", out: str = "pieces") -> DataFrame:
    """``docs`` plus a struct ``out``: the piece ``ids`` of the text, without ids
    for its begin or end, and the text ``decoded`` from them.

    ``model_file``: the content of a model file (under 1 MB, shipped with the
    task).  A null text counts as empty: no ids, an empty text.  A word mark
    (U+2581) in a text is decoded as a space, as the format has it.  Very long
    texts and words are encoded whole.  Other columns pass through; one named
    ``out`` is replaced.
    """
    pieces = load_model(model_file)
    made = docs.sparkSession.sparkContext.broadcast((pieces, Remerge(pieces).last_merges()))

    def start():
        return Encoder(*made.value).run

    return append(docs, text, out, ENCODED, start)
