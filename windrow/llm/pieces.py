"""SentencePiece encoding by a prefix table, and decoding.

A merge-type (BPE) encoding has one last token for each prefix of a text, and a sequence of
tokens is the encoding exactly when each neighbouring pair is: the pair's text alone encodes
to the pair. So the last token of a prefix is the one that ends there, as an automaton over
all pieces finds, and goes with the last token of what stands before it. Ids are then read
off backwards. No merge queue over the text is needed. The table of a segment is an array by
the lengths of its prefixes; short segments' ids are remembered, within bounds in bytes.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from windrow.llm import common

SPACE = "▁"

#: Bytes, as Python holds them, of the segments and ids that a worker remembers, and of pairs.
IDS_BYTES, PAIRS_BYTES = 80 << 20, 64 << 20

#: Segments beyond so many characters are not remembered.
LONG = 64

#: The "token" of a character that no piece has: any token may stand next to it.
NONE = -1


class Automaton:
    """States over all pieces: what has been read so far ends in these pieces, longest first."""

    def __init__(self, pieces: dict[str, int]):
        self.go: list[dict[str, int]] = [{}]
        own: list[int | None] = [None]
        for piece, token in pieces.items():
            at = 0
            for c in piece:
                at = self.go[at].setdefault(c, len(self.go))
                if at == len(self.go):
                    self.go.append({})
                    own.append(token)
                    own[at] = None
            own[at] = token
        self.fail, depth, self.ending = [0] * len(self.go), [0] * len(self.go), [()] * len(self.go)
        queue = [0]
        for at in queue:
            for c, to in self.go[at].items():
                depth[to] = depth[at] + 1
                self.fail[to] = self.step(self.fail[at], c) if at else 0
                mine = () if own[to] is None else ((depth[to], own[to]),)
                self.ending[to] = mine + self.ending[self.fail[to]]
                queue.append(to)

    def step(self, at: int, c: str) -> int:
        while c not in self.go[at]:
            if not at:
                return 0
            at = self.fail[at]
        return self.go[at][c]


class Encoder:
    """Ids of a text, equal to those of the library's own merge loop; ``share`` of the bytes is for what is remembered."""

    def __init__(self, model: str, share: float = 1.0):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("unused pieces are split again after merging, which is not supported")
        reserved = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.piece = {i: sp.id_to_piece(i) for i in range(n) if i not in reserved}
        if any(SPACE in p.lstrip(SPACE) for p in self.piece.values()):
            raise ValueError("pieces that go on behind a space are not supported")
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            self.bytes = None
        # Behind a character that no piece has, a text is encoded as if it stood alone.
        self.gap = next(c for c in "\n\x00\uffff" if not any(c in p for p in self.piece.values()))
        self.before = len(sp.encode(self.gap))
        # Only a piece that its own text encodes to can be a token.
        self.automaton = Automaton({p: i for i, p in self.piece.items() if self._library(p) == [i]})
        self.length = {i: len(p) for i, p in self.piece.items()}
        self.pairs = common.Memory(self._fits, int(PAIRS_BYTES * share))
        self.ids = common.Memory(self._segment, int(IDS_BYTES * share), lambda key: len(key) <= LONG)
        # Every segment begins with a space, which its key leaves out.
        self.first = self.automaton.step(0, SPACE)
        self.first_token = next((t for _, t in self.automaton.ending[self.first]), NONE)

    def _library(self, text: str) -> list[int]:
        """What the library's merges make of a short text that stands alone."""
        return self.sp.encode(self.gap + text)[self.before :]

    def _fits(self, pair: int) -> bool:
        a, b = pair >> 32, pair & 0xFFFFFFFF
        return self._library(self.piece[a] + self.piece[b]) == [a, b]

    def _table(self, key: str) -> Sequence[int]:
        """The last token of each prefix of the segment, by the prefix's length without its space."""
        go, fail, ending, pairs = self.automaton.go, self.automaton.fail, self.automaton.ending, self.pairs
        state, lasts = self.first, [self.first_token]
        if len(key) > LONG:
            lasts = array("i", lasts)
        for whole, char in enumerate(key, 2):
            while char not in go[state]:
                if not state:
                    break
                state = fail[state]
            else:
                state = go[state][char]
            last = NONE
            for length, token in ending[state]:
                if length != whole:
                    left = lasts[whole - 1 - length]
                    if left != NONE and not pairs[left << 32 | token]:
                        continue
                last = token
                break
            lasts.append(last)
        return lasts

    def _char(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.sp.unk_id()]

    def _segment(self, key: str) -> bytes:
        """Ids from the table, from its end."""
        lasts, ids, at = self._table(key), array("i"), len(key)
        while at >= 0:
            last = lasts[at]
            if last == NONE:
                ids.extend(reversed(self._char(key[at - 1] if at else SPACE)))
                at -= 1
            else:
                ids.append(last)
                at -= self.length[last]
        ids.reverse()
        return ids.tobytes()

    def _keys(self, text: str) -> list[str]:
        """A text falls apart before each run of spaces, as no piece goes on behind one."""
        text = self.sp.normalize(text)
        if not text:
            return []
        if not text.startswith(SPACE):
            raise ValueError("the model's normalizer adds no space in front, which is not supported")
        if SPACE * 2 in text or text.endswith(SPACE):
            return [m[1:] for m in re.findall(f"{SPACE}+[^{SPACE}]*", text)]
        return text[1:].split(SPACE)

    def encode(self, text: str) -> np.ndarray:
        """Segments occur again and again, so each is encoded once while it is remembered."""
        return np.frombuffer(b"".join(map(self.ids.__getitem__, self._keys(text))), dtype=np.int32)


_ENCODERS: dict[tuple[str, float], Encoder] = {}


def encoder(model: str, share: float = 1.0) -> Encoder:
    """One per worker process: what it remembers serves the next task too."""
    if (model, share) not in _ENCODERS:
        _ENCODERS[model, share] = Encoder(model, share)
    return _ENCODERS[model, share]


def _coder(model: str, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = encoder(model, share)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids = [mine.encode(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                decoded = [mine.sp.decode(i.tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )
        common.give_back()

    return run


def encode(docs: DataFrame, doc_id: str, text: str, model: str, share: float = 1.0) -> DataFrame:
    """doc_id, ids (without begin or end ids) and the text they decode to, for each row.

    A null text counts as empty and has no ids. Texts are taken whole, whatever their length;
    repeated rows give repeated results; an empty table gives an empty result. ``model`` is a
    path that every worker can open. With a smaller ``share`` a worker remembers less and takes longer.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return common.in_small_batches(docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")).mapInArrow(
        _coder(model, share), f"doc_id {kind}, ids array<int>, decoded string"
    )
