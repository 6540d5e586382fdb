import random
import tracemalloc

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from windrow.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MINE, PLAIN = pieces.Encoder(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁\nthein.,")), max_size=60))
def test_equals_the_library(text):
    assert MINE.encode(text).tolist() == PLAIN.encode(text)


def test_repeats_and_full_memory(monkeypatch):
    monkeypatch.setattr(pieces, "IDS_BYTES", 5000)
    monkeypatch.setattr(pieces, "PAIRS_BYTES", 5000)
    small = pieces.Encoder(MODEL)
    for text in ["aaaaaaaaaaaaaaaaaaaaaaa", "====----____", "<s> </s> <unk> <0x0A>", " thinthethin" * 40, "日本🙂" * 9] * 3:
        assert small.encode(text).tolist() == PLAIN.encode(text)


def test_rows(spark, odd, none):
    got = pieces.encode(odd, "doc_id", "text", MODEL).collect()
    want = [(r.doc_id, PLAIN.encode(r.text or "")) for r in odd.collect()]
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(i), ids) for i, ids in want)
    assert all(r.decoded == PLAIN.decode(list(r.ids)) for r in got)
    assert pieces.encode(none, "doc_id", "text", MODEL).collect() == []


def test_long_text_without_spaces():
    """A segment of n characters takes memory in proportion to n, and none of it stays."""
    small = pieces.Encoder(MODEL)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz0123456789+/", "日本語文字列処理中国的一是不了人我在有他这"):
        draw = random.Random(5)
        text = "".join(draw.choices(alphabet, k=10_000))
        tracemalloc.start()
        got = small.encode(text).tolist()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got == PLAIN.encode(text) and most < 10_000_000
        assert not [k for k in (*small.ids, *small.ids.old) if len(k) > 64]
    text = "".join(draw.choices(alphabet + "thequickbrown", k=1_000_000))
    assert small.encode(text).tolist() == PLAIN.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="▁thein.,=-日本🙂é", min_size=65, max_size=300))
def test_long_segments_equal_the_library(text):
    text = text.replace("▁", "")
    assert MINE.encode(text).tolist() == PLAIN.encode(text)
