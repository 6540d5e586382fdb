"""Token ids in Arrow stream files of equal-length sequences.

A file holds record batches of fixed-size lists: the ids, a mask of the places that are in use,
and a mask of the places where a document begins. A reader maps the file and has any sequence
at once, without copying. The ids of the documents stand in the schema's metadata, in order.
"""

from __future__ import annotations

import io
import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from windrow.llm import common, files
from windrow.session import materialise

#: Ids in a sequence, sequences in a batch, and the ids at which a file is closed behind a document.
SEQUENCE, BATCH, FILE_IDS = 1024, 256, 2 << 20

#: Bytes, as Python holds them, of the pieces of text that a worker remembers and their ids.
PIECE_BYTES, TAIL_BYTES = 128 << 20, 1 << 20

#: Marks that no letter or number belongs to; an apostrophe may begin a pre-token with letters.
_MARKS = string.punctuation.replace("'", "")


#: The characters by which byte-level tokenizers write bytes: printable ones stand for
#: themselves, the others follow from 256 on.
_BYTE_CHARS = {}
for _b in range(256):
    _printable = 33 <= _b <= 126 or 161 <= _b <= 172 or 174 <= _b <= 255
    _BYTE_CHARS[_b] = _b if _printable else 256 + sum(v >= 256 for v in _BYTE_CHARS.values())


#: What is written for a space.
_SPACE = chr(_BYTE_CHARS[ord(" ")])


class Encoder:
    """The tokenizer's ids, with the ids of pieces between single white spaces remembered.

    For a byte-level tokenizer a space or line end with no white space beside it begins a new
    pre-token, or is one, so the pieces that it parts are encoded on their own. Texts with
    other white space, or with a special token, are encoded as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        self.parts = (spec["model"]["type"], before.get("type")) == ("BPE", "ByteLevel")
        self.parts = self.parts and before.get("use_regex", True) and not before["add_prefix_space"]
        self.parts = self.parts and not spec["normalizer"]
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.white = re.compile(r"[^\S \n]")
        # Taken once: each look at ``model`` makes a new object.
        self.merges = self.tokenizer.model.tokenize if self.parts else None
        self.known = common.Memory(self._piece, PIECE_BYTES)
        self.tails = common.Memory(lambda tail: self._whole([tail])[0], TAIL_BYTES)

    def _whole(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", c.ids).tobytes() for c in coded]

    def _letters(self, word: str) -> bytes:
        """Letters, with a space before them or none, are one pre-token: its bytes go to the merges directly."""
        if word.isascii():
            # Letters stand for themselves.
            chars = _SPACE + word[1:] if word[0] == " " else word
        else:
            chars = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.merges(chars)]).tobytes()

    def _piece(self, key: str) -> bytes:
        """Ids of a piece that a space stands in front of, or that begins with a line end."""
        bare = key.rstrip(_MARKS)
        if bare.isalpha():
            if bare is key:
                return self._letters(" " + key)
            # Marks behind letters are a pre-token of their own.
            return self.known[bare] + self.tails[key[len(bare) :]]
        if key[:1] != "\n":
            return self._whole([" " + key])[0]
        if bare[1:].isalpha():
            return self.tails["\n"] + self._letters(bare[1:]) + (self.tails[key[len(bare) :]] if len(bare) < len(key) else b"")
        return self._whole([key])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.parts:
            return self._whole(texts)
        find, split = self.known.__getitem__, []
        for text in texts:
            spaced = text.replace("\n", " \n")
            keys = None if self._odd(text, spaced) else spaced.split(" ")
            split.append(keys)
        # One call for all that is not looked up: first pieces, and odd texts.
        heads = self._whole([keys[0] if keys else text for keys, text in zip(split, texts)])
        return [b"".join([head, *map(find, keys[1:])]) if keys else head for keys, head in zip(split, heads)]

    def _odd(self, text: str, spaced: str) -> bool:
        """Is there white space beside other white space or at an end, of another kind, or a special token?"""
        if "  " in spaced or "\n " in spaced or spaced[:1] in ("", " ") or spaced[-1] in " \n":
            return True
        # Printable characters are no white space but the space; that is quicker to see than to search for.
        if not text.replace("\n", "").isprintable() and self.white.search(text):
            return True
        return any(m in text for m in self.marks)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, in its own thread: Spark has a worker for each core.

    The library's threads cost more than they do for the short texts that it gets here.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def build_file(doc_ids: list, coded: list[np.ndarray], kind: pa.DataType, ids: pa.DataType, sequence: int) -> bytes:
    """One stream file; the last sequence is filled up with zeros that the mask leaves out."""
    lengths = np.array([len(c) for c in coded], dtype=np.int64)
    used = int(lengths.sum())
    rows = -(-used // sequence)
    flat = np.zeros(rows * sequence, dtype=ids.to_pandas_dtype())
    flat[:used] = np.concatenate(coded)
    mask, first = np.zeros(len(flat), dtype=bool), np.zeros(len(flat), dtype=bool)
    mask[:used] = True
    first[np.cumsum(lengths) - lengths] = True
    names = io.BytesIO()
    with pa.ipc.new_stream(names, pa.schema([("doc_id", kind)])) as w:
        w.write_table(pa.table({"doc_id": pa.array(doc_ids, kind)}))
    schema = pa.schema(
        [
            ("ids", pa.list_(ids, sequence)),
            ("mask", pa.list_(pa.bool_(), sequence)),
            ("first", pa.list_(pa.bool_(), sequence)),
        ],
        metadata={"documents": names.getvalue()},
    )
    out = io.BytesIO()
    with pa.ipc.new_stream(out, schema) as w:
        for at in range(0, rows, BATCH):
            part = slice(at * sequence, min(at + BATCH, rows) * sequence)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x[part]), sequence) for x in (flat, mask, first)
            ]
            w.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return out.getvalue()


class TokenFile:
    """Sequences and masks of a stream file, without copying them out of ``buffer``."""

    def __init__(self, buffer):
        reader = pa.ipc.open_stream(pa.py_buffer(buffer))
        self.batches = list(reader)
        self.doc_ids = pa.ipc.open_stream(pa.py_buffer(reader.schema.metadata[b"documents"])).read_all()["doc_id"]
        self.sequence = reader.schema.field("ids").type.list_size

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence_at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of sequence ``i``, a view into the buffer, and its mask."""
        batch, row = self.batches[i // BATCH], i % BATCH
        part = slice(row * self.sequence, (row + 1) * self.sequence)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[part], batch.column(1).flatten().to_numpy(zero_copy_only=False)[part]

    def documents(self) -> Iterator[tuple[object, np.ndarray]]:
        flat = np.concatenate([b.column(0).flatten().to_numpy() for b in self.batches])
        mask = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in self.batches])
        first = np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in self.batches])
        edges = [*np.flatnonzero(first), int(mask.sum())]
        for i, doc_id in enumerate(self.doc_ids.to_pylist()):
            yield doc_id, flat[edges[i] : edges[i + 1]]


def _writer(tokenizer: str, end_id: int, sequence: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids_type = pa.uint32() if mine.wide else pa.uint16()
        doc_ids, coded, held, count, kind = [], [], 0, 0, None

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, coded, held, count
            content = build_file(doc_ids, coded, kind, ids_type, sequence)
            doc_ids, coded, held, count = [], [], 0, count + 1
            name = f"{part:08d}-{count - 1:08d}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["name", "content"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128)
                texts = [t or "" for t in rows.column(1).to_pylist()]
                for doc_id, ids in zip(rows.column(0).to_pylist(), mine.encode(texts)):
                    doc_ids.append(doc_id)
                    coded.append(np.append(np.frombuffer(ids, dtype="<u4"), end_id).astype(ids_type.to_pandas_dtype()))
                    held += len(coded[-1])
                    if held >= file_ids:
                        yield close()
        if doc_ids:
            yield close()
        common.give_back()

    return run


def write(
    docs: DataFrame,
    path: str,
    doc_id: str,
    text: str,
    tokenizer: str,
    end_id: int = 0,
    sequence: int = SEQUENCE,
    file_ids: int = FILE_IDS,
) -> None:
    """Encode whole texts and write them in ascending order of ``doc_id``.

    Documents are dealt out by ranges of ids, so files named by partition and number are in
    order too. A file is closed behind the document with which it reaches ``file_ids``; a
    worker holds one file at a time. A null text counts as empty and has the end id only;
    null ids come first; rows with the same id stay next to each other, in any order.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = common.in_small_batches(ordered).mapInArrow(_writer(tokenizer, end_id, sequence, file_ids), "name string, content binary")
    files.write(made, path, "name", "content")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            name, stored = batch.column(0)[i].as_py(), TokenFile(batch.column(1)[i].as_buffer())
            found = list(stored.documents())
            lengths = np.array([len(ids) for _, ids in found], dtype=np.int64)
            sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(found), pa.string()),
                    stored.doc_ids.combine_chunks() if isinstance(stored.doc_ids, pa.ChunkedArray) else stored.doc_ids,
                    pa.array(np.cumsum(lengths) - lengths),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                names=["name", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read(spark, path: str, kind: str = "bigint") -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Offsets of files come from one row per file: summed within a partition's files, and over
    one row per partition.
    """
    found = files.read(spark, path).mapInArrow(
        _reader, f"name string, doc_id {kind}, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    found = materialise(found.withColumn("part", F.substring_index("name", "-", 1)), "token-index")
    sizes = found.groupBy("part", "name").agg(F.sum("n_tokens").alias("n"))
    behind = Window.partitionBy("part").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    in_part = sizes.select("part", "name", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("in_part"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per partition of the writing job.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    placed = in_part.join(offsets, "part").select("name", (F.col("in_part") + F.col("offset")).alias("offset"))
    return found.join(placed, "name").select(
        "doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
