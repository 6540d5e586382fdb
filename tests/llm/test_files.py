"""Token files and archives: bytes that other readers understand, and exact round trips."""

import hashlib
import io
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from windrow.llm import files, token_files, warc
from windrow.session import work_path

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_files_keep_every_byte(spark):
    contents = [bytes(range(256)) * 3 + b"\0", b"\0", b"\n\r\n\0\0", b"\xff\xfe\0"]
    path = work_path(spark, "files")
    df = spark.createDataFrame([(f"n{i}", bytearray(c)) for i, c in enumerate(contents)], "name string, content binary")
    files.write(df, path, "name", "content")
    got = {r.name: bytes(r.content) for r in files.read(spark, path).collect()}
    assert got == {f"n{i}": c for i, c in enumerate(contents)}


def test_encoder_equals_the_library():
    mine, plain = token_files.Encoder(BPE), Tokenizer.from_file(BPE)
    assert mine.parts
    texts = ["", "  a  b ", "\n\n x\ty", "a \n b", "a\nb.\n,c", "a\x1c b", "don't 's", "x <|endoftext|> y", ", . é, 日.", "a\r\nb"]
    rng = np.random.default_rng(0)
    texts += ["".join(rng.choice(list(" ab.,'st1\n\t é日-_"), 30)) for _ in range(2000)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in mine.encode(texts)]
        assert got == [c.ids for c in plain.encode_batch(texts, add_special_tokens=False)]


def test_first_pieces_of_a_batch_are_one_call():
    mine, calls = token_files.Encoder(BPE), []
    whole = mine._whole
    mine._whole = lambda texts: calls.append(len(texts)) or whole(texts)
    texts = [f"First{'abc'[i % 3]} of the words\nof a text" for i in range(100)]
    got = mine.encode(texts)
    assert [c for c in calls if c > 1] == [100] and calls.count(1) <= 2
    assert got == whole(texts)


@pytest.mark.parametrize("file_ids", [1 << 20, 3000])
def test_token_files(spark, odd, none, file_ids):
    path = work_path(spark, "tokens")
    token_files.write(odd, path, "doc_id", "text", BPE, sequence=128, file_ids=file_ids)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    rows, plain = odd.collect(), Tokenizer.from_file(BPE)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in rows)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got]).tolist()[:-1]
    want = {}
    for r in rows:
        coded = np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(r.doc_id, set()).add((len(coded), zlib.crc32(coded.tobytes())))
    assert all((r.n_tokens, r.ids_crc32) in want[r.doc_id] for r in got)
    # Any reader of the format has the sequences, all of one length, and none is copied.
    for r in files.read(spark, path).collect():
        content = bytes(r.content)
        batch = pa.ipc.open_stream(io.BytesIO(content)).read_next_batch()
        assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 128)
        stored = token_files.TokenFile(content)
        one, mask = stored.sequence_at(len(stored) - 1)
        assert len(one) == len(mask) == 128 and not one[~mask].any() and not one.flags.owndata
    empty = work_path(spark, "tokens")
    token_files.write(none, empty, "doc_id", "text", BPE)
    assert token_files.read(spark, empty).collect() == []


PAGES = [
    (1, "http://a/1", "x" * 1000),
    (2, "http://a/2", "x" * 1000),
    (3, None, "x" * 1000),
    (4, "http://a b\r\n/4", "x" * 999),
    (5, "http://a/5", "x" * 999),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (None, "http://a/n", "x" * 1000),
    (None, "http://a/n", "y" * 2000),
    (None, "http://a/n", "y" * 2000),
    (10, "http://a/10", "WARC/1.1\r\n\r\n" * 20_000 + "\0"),
]


def test_warc(spark):
    df = spark.createDataFrame([(*r, "k", 1) for r in PAGES], "page_id long, url string, html string, _id string, refers_to int")
    path = work_path(spark, "warc")
    warc.write(df, path, "page_id", "url", "html", archive_bytes=4000)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(spark, path).collect())
    refers = {1: 3, 2: 3, 8: 9}
    want = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        to = 3 if page_id is None and html[0] == "x" else refers.get(page_id)
        want.append((str(page_id), len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if to else "response", to))
    assert got == sorted(want, key=lambda r: r[:4])
    responses = warc.read(spark, path).where("record_type = 'response' AND page_id = 10").collect()
    assert bytes(responses[0].payload).decode() == PAGES[-1][2]


def test_archives_are_plain_zstandard_frames(spark):
    """A dictionary in a leading skippable frame; every record a frame of its own."""
    rng = np.random.default_rng(5)
    pages = [(i, f"http://a/{i}", "<html>" + " ".join(rng.choice(["lorem", "ipsum", "dolor"], 300))) for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = work_path(spark, "warc")
    warc.write(df, path, "page_id", "url", "html")
    (content,) = [bytes(r.content) for r in files.read(spark, path).collect()]
    parts = list(warc.frames(content))
    assert parts[0][0] == 0x184D2A5D and len(parts[0][1]) > 256
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(parts[0][1]))
    bodies = [opener.decompress(body) for magic, body in parts if magic is None]
    assert len(bodies) == 200 and all(b.startswith(b"WARC/1.1\r\n") and b.endswith(b"\r\n\r\n") for b in bodies)
    assert warc.build_dictionary(df.limit(0), "page_id", "html") == b""
    empty = work_path(spark, "warc")
    warc.write(df.limit(0), empty, "page_id", "url", "html")
    assert warc.read(spark, empty).collect() == []
    assert json.dumps(sorted(r.page_id for r in warc.read(spark, path).collect())) == json.dumps(list(range(200)))
