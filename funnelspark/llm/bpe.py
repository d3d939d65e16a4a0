"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a text is a sequence in which every pair of neighbouring tokens is *compatible*: merging the bytes of
both gives the same two tokens again. For every prefix of a piece exactly one token can be the last one, so one pass suffices: an
automaton reports all tokens that end at a position, and the one that is compatible with the last token of the prefix before it
is stored. Following the stored tokens backwards yields the exact ids, in time linear in the piece whatever its length.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import map_rows

#: Pieces that a worker keeps encoded, and neighbour tests it keeps (some 200 bytes each). An idle worker keeps them too, beside what the executor does next.
KEPT_PIECES, KEPT_PAIRS = 160_000, 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself if visible in Latin-1, else the next free character from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _ranges(test) -> str:
    """Characters that pass ``test``, as the inside of a character class."""
    found, start = [], None
    for code in range(0x110001):
        inside = code < 0x110000 and test(code)
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            found.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(found)


def piece_pattern(stop: int = 0x110000) -> re.Pattern:
    """Contractions, words, numbers and other runs with an optional space before them, and white space.

    For texts with code points below ``stop`` only. Below 65,536 a class is one table; each range beyond is tried in turn at every character
    that ends a run.
    """
    import regex

    every = "".join(map(chr, [c for c in range(stop) if not 0xD800 <= c < 0xE000]))
    letters, numbers, spaces = ({ord(c) for c in regex.findall(p, every)} for p in (r"\p{L}", r"\p{N}", r"\p{White_Space}"))
    el, nu, sp = (_ranges(s.__contains__) for s in (letters, numbers, spaces))
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{el}]+| ?[{nu}]+| ?[^{sp}{el}{nu}]+|[{sp}]+(?![^{sp}])|[{sp}]+")


class PrefixEncoder:
    def __init__(self, definition: dict):
        import ahocorasick

        model, alphabet = definition["model"], byte_alphabet()
        spell = lambda token: bytes(alphabet[c] for c in token)
        ids = model["vocab"]
        self.bytes_of = {i: spell(t) for t, i in ids.items()}
        self.special = {x["content"]: x["id"] for x in definition.get("added_tokens", [])}
        self.bytes_of |= {i: c.encode() for c, i in self.special.items()}
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pair_ids, whole = (ids[left], ids[right]), ids[left + right]
            self.merge_rank.setdefault(pair_ids, rank)
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = pair_ids, rank
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            raw = spell(token)
            if len(raw) == 1 or i in self.parts:
                self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find_any, self.find_near, self.far = piece_pattern().findall, piece_pattern(0x10000).findall, re.compile("[\U00010000-\U0010ffff]").search
        # Each in two generations of half the number: when the new one is full the old one goes, but what is used meanwhile moves to the new one.
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.old_pairs: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at one side of ``token`` while it is built, each with the rank at which it is merged away."""
        gone, edge = 1 << 60, []
        while True:
            edge.append((token, gone))
            if token not in self.parts:
                return edge
            gone, token = self.born[token], self.parts[token][side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two tokens.

        A crossing merge of rank r needs both its halves present at r. Of equal ranks the leftmost merge comes first, so it beats
        the merge that would consume its right half but not the one that consumes its left half.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self.old_pairs.get((left, right))
            if known is None:
                known = self._uncrossed(left, right)
            if len(self.pairs) >= KEPT_PAIRS // 2:
                self.old_pairs, self.pairs = self.pairs, {}
            self.pairs[left, right] = known
        return known

    def _uncrossed(self, left: int, right: int) -> bool:
        for a, a_gone in self._edge(left, 1):
            for b, b_gone in self._edge(right, 0):
                rank = self.merge_rank.get((a, b))
                if rank is not None and rank < a_gone and rank <= b_gone:
                    return False
        return True

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        last = [-1] * (len(piece) + 1)
        size = [0] * (len(piece) + 1)
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            stop = end + 1
            if last[stop] < 0:
                before = stop - length
                if before == 0 or (last[before] >= 0 and self.compatible(last[before], token)):
                    last[stop], size[stop] = token, length
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def find(self, text: str) -> list[str]:
        """Pieces of a text."""
        return self.find_near(text) if text.isascii() or not self.far(text) else self.find_any(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.splitter.split(text) if self.splitter else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
                continue
            found = self.find(part)
            try:
                out.append(b"".join(map(self.pieces.__getitem__, found)))
            except KeyError:
                for piece in set(found).difference(self.pieces):
                    if len(piece) <= 64:
                        if len(self.pieces) >= KEPT_PIECES // 2:
                            self.old_pieces, self.pieces = self.pieces, {}
                        self.pieces[piece] = self.old_pieces.get(piece) or self._packed(piece)
                out.append(b"".join(self.pieces.get(p) or self.old_pieces.get(p) or self._packed(p) for p in found))
        return b"".join(out)

    def _packed(self, piece: str) -> bytes:
        ids = self.encode_bytes(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(definition: str) -> PrefixEncoder:
    """The encoder for a tokenizer file's content, once per worker process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = PrefixEncoder(json.loads(definition))
    return _ENCODERS[key]


def encode_texts(df: DataFrame, text: Column, path: str, ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """``df`` (all columns or those to ``keep``) with n_tokens, ids (if asked for), ids_sha256, decoded and decoded_sha256 of each whole text.

    ``path`` names a byte-level BPE file of the tokenizers format (a few MB, read by the driver). A null text counts as empty and has no
    ids. Rows, repeated ones included, are encoded each on its own, in order of nothing; an input column of an output's name is
    replaced. Ids are a binary column of little-endian unsigned 32-bit integers.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField("ids", T.BinaryType())] if ids else []

    def run(values: list[bytes]) -> list[list]:
        coder = encoder(definition)
        packed = [coder.encode(v.decode("utf-8", "replace")) for v in values]
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        out = [[len(p) // 4 for p in packed], [sha(p) for p in packed], [sha(coder.decode(p).encode()) for p in packed]]
        return [*out, packed] if ids else out

    return map_rows(df, F.coalesce(text, F.lit("")), T.StructType(fields), run, keep=keep)
