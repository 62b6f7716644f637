"""SentencePiece encoding and decoding by a table of prefixes' last tokens.

Every prefix of a text has one encoding, so one last token. Automaton matches give the tokens
that end at a place; the one that is compatible with the last token of the prefix before it is that
place's entry. Two tokens are compatible if the merges of the joined string never cross from one
into the other. The ids are read from the table backwards. Time is linear in the text, whatever
its words.

A text is cut before each run of U+2581 and around line ends, which no piece of the model crosses
(checked when the model is loaded). Frequent units are looked up in a bounded cache.

Defined cases: a NULL text is empty; an empty one has only the begin and end ids. Characters that
the model does not hold become their UTF-8 bytes' pieces. In decoding, bytes that are no UTF-8
become U+FFFD each. Columns ``ids`` and ``decoded`` are replaced if there already.
"""

from __future__ import annotations

import re
import uuid
from functools import cached_property

import numpy as np
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import add_results

MARK = "▁"
CACHED_UNITS = 300_000
CACHED_PAIRS = 300_000
LONGEST_CACHED = 64
NEVER = float("-inf")


def load_pieces(model_path: str) -> list[tuple[str, float, str]]:
    """Piece, score and kind of each id of a model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)

    def kind(i: int) -> str:
        if model.is_control(i):
            return "control"
        if model.is_unknown(i):
            return "unknown"
        return "byte" if model.is_byte(i) else "unused" if model.is_unused(i) else "normal"

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


class Codec:
    """Encodes and decodes with the pieces of a merge-type model that has byte fallback, a dummy
    prefix and no other normalisation."""

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        self.pieces = pieces
        self.score = {p: s for p, s, k in pieces if k == "normal"}
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        self.begin, self.end = (next(i for i, x in enumerate(pieces) if x[0] == p) for p in ("<s>", "</s>"))
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        if any(MARK in p.lstrip(MARK) or "\n" in p[1:] or p != "\n" and p[0] == "\n" for p in self.id):
            raise ValueError("a piece crosses the places where texts are cut")
        if missing := {c for p in self.id for c in p} - self.id.keys():
            raise ValueError(f"characters without a piece of their own: {sorted(missing)[:5]}")
        # what was asked for lately; at half the bound the younger half takes the older one's place
        self._pairs: dict[tuple[str, str], bool] = {}
        self._older_pairs: dict[tuple[str, str], bool] = {}
        self._units: dict[str, bytes] = {}
        self._older_units: dict[str, bytes] = {}

    @cached_property
    def _automaton(self):  # noqa: ANN202
        import ahocorasick

        found = ahocorasick.Automaton()
        for piece in self._histories:
            found.add_word(piece, piece)
        found.make_automaton()
        return found

    @cached_property
    def _histories(self) -> dict[str, tuple[list, list]]:
        """For each piece that its own string is merged to: the leftmost and the rightmost symbol
        before each merge, with that merge's score."""
        out = {}
        for piece in self.id:
            symbols = list(piece)
            left, right = [], []
            while True:
                best, at = NEVER, -1
                for i in range(len(symbols) - 1):
                    if (s := self.score.get(symbols[i] + symbols[i + 1], NEVER)) > best:
                        best, at = s, i
                left.append((symbols[0], best))
                right.append((symbols[-1], best))
                if at < 0:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            if len(symbols) == 1:
                out[piece] = (left, right)
        return out

    def compatible(self, pair: tuple[str, str]) -> bool:
        """No merge across the border comes first while both strings merge side by side. Merges
        go by score, from the left among equals."""
        if len(self._pairs) >= CACHED_PAIRS // 2:
            self._pairs, self._older_pairs = {}, self._pairs
        known = self._older_pairs.get(pair)
        if known is None:
            known = self._compare(*pair)
        self._pairs[pair] = known
        return known

    def _compare(self, a: str, b: str) -> bool:
        alone = [(None, NEVER)]
        ends = self._histories[a][1] if a in self._histories else alone
        starts = self._histories[b][0] if b in self._histories else alone
        i = j = 0
        while True:
            (x, s), (y, t) = ends[i], starts[j]
            across = self.score.get(x + y, NEVER) if x and y else NEVER
            if across > s and across >= t:
                return False
            if s == t == NEVER:
                return True
            if s >= t:
                i += 1
            else:
                j += 1

    def _encode_unit(self, unit: str) -> bytes:
        last: list[str] = list(f" {unit}")  # a character that ends no piece stands for itself
        found = bytearray(len(last))
        pairs, compatible = self._pairs, self.compatible  # a full cache that has been replaced holds true all the same
        for at, piece in self._automaton.iter(unit):
            at += 1
            if not found[at]:
                before = at - len(piece)
                if before:
                    pair = (last[before], piece)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = compatible(pair)
                    if not fits:
                        continue
                last[at] = piece
                found[at] = 1
        parts: list[bytes] = []
        at = len(unit)
        while at:
            piece = last[at]
            parts.append(self._packed.get(piece) or self._bytes_of(piece))
            at -= len(piece)
        parts.reverse()
        return b"".join(parts)

    @cached_property
    def _packed(self) -> dict[str, bytes]:
        return {p: self._edge(i) for p, i in self.id.items()}

    def _bytes_of(self, character: str) -> bytes:
        return b"".join(self._edge(self.byte[b]) for b in character.encode())

    _UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end."""
        parts = [self._edge(self.begin)]
        if text:
            units = self._units
            for unit in self._UNIT.findall(MARK + text.replace(" ", MARK)):
                ids = units.get(unit)
                if ids is None:
                    ids = self._older_units.get(unit) or self._encode_unit(unit)
                    if len(unit) <= LONGEST_CACHED:
                        if len(units) >= CACHED_UNITS // 2:
                            self._units, self._older_units = {}, units
                            units = self._units
                        units[unit] = ids
                parts.append(ids)
        parts.append(self._edge(self.end))
        return b"".join(parts)

    @staticmethod
    def _edge(token: int) -> bytes:
        return np.array([token], dtype="<u4").tobytes()

    @cached_property
    def _spelled(self) -> list[bytes]:
        of = {"control": lambda p: b"", "unknown": lambda p: " ⁇ ".encode(), "byte": lambda p: bytes([int(p[3:5], 16)])}
        return [of[k](p) if k in of else p.replace(MARK, " ").encode() for p, _, k in self.pieces]

    def decode(self, ids: bytes) -> str:
        spelled = self._spelled
        tokens = np.frombuffer(ids, dtype="<u4").tolist()
        whole = b"".join([spelled[t] for t in tokens])
        try:
            text = whole.decode()
        except UnicodeDecodeError:
            text = _decode_apart(whole)
        first = next((self.pieces[t] for t in tokens if self.pieces[t][2] != "control"), None)
        return text[1:] if first and first[2] == "normal" and first[0].startswith(MARK) else text


def _decode_apart(data: bytes) -> str:
    """UTF-8, with U+FFFD for every single byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


#: The codec of the call that this worker last ran a task of, by its name: one for all its tasks.
_KEPT: list[tuple[str, Codec]] = []


def _codec_of(name: str, pieces: Broadcast) -> Codec:
    if not _KEPT or _KEPT[0][0] != name:
        _KEPT.clear()  # before the next is made
        _KEPT.append((name, Codec(pieces.value)))
    return _KEPT[0][1]


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids`` (packed, see ``Codec.encode``) and ``decoded``."""
    shared, name = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path)), uuid.uuid4().hex

    def run(text: str | None) -> tuple[bytes, str]:
        codec = _codec_of(name, shared)
        ids = codec.encode(text)
        return ids, codec.decode(ids)

    # not by Arrow: its batches hold 10,000 texts at once, with their ids and decoded texts, in the JVM and in Python
    coded = F.udf(run, "ids binary, decoded string", useArrow=False)
    return add_results(docs, coded("text"), ["ids", "decoded"])
