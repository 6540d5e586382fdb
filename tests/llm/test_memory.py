import os
import subprocess
import sys

import public_tokenizers

from windrow.llm import common, pieces


def held(memory):
    return sum(sys.getsizeof(k) + sys.getsizeof(v) for part in (memory, memory.old) for k, v in part.items())


def test_memory_stays_within_its_bytes():
    made = []
    memory = common.Memory(lambda k: made.append(k) or k * 2, 20_000)
    for i in range(5000):
        assert memory[f"word {i}"] == f"word {i}" * 2
        assert memory["often"] == "oftenoften"
        assert held(memory) <= 20_000 + 200
    assert made.count("often") == 1


def test_memory_keeps_only_what_it_may():
    memory = common.Memory(len, 1000, lambda k: len(k) < 3)
    assert [memory[k] for k in ("ab", "abcd", "abcd")] == [2, 4, 4]
    assert list(memory) == ["ab"]


def test_an_encoder_with_little_memory_finds_the_same(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [" ".join(f"wórd{i % 97}x{i % 41} ünd" for i in range(k, k + 400)) for k in range(30)]
    wide = [pieces.encoder(path).encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces, "IDS_BYTES", 4000)
    monkeypatch.setattr(pieces, "PAIRS_BYTES", 2000)
    narrow = pieces.Encoder(path)
    assert [narrow.encode(t).tolist() for t in texts] == wide
    assert wide == [narrow.sp.encode(t) for t in texts]
    assert held(narrow.ids) <= 5000 and held(narrow.pairs) <= 12_000


def test_an_encoder_with_a_share_remembers_less_and_finds_the_same():
    path = public_tokenizers.path("piece_bpe_32k.model")
    narrow = pieces.encoder(path, 0.0001)
    texts = [" ".join(f"wörd{i % 97}x{i % 41} and" for i in range(k, k + 400)) for k in range(30)]
    assert [narrow.encode(t).tolist() for t in texts] == [narrow.sp.encode(t) for t in texts]
    assert narrow.ids.limit == int(pieces.IDS_BYTES * 0.0001) and held(narrow.ids) <= narrow.ids.limit + 1000
    assert pieces.encoder(path) is not narrow and pieces.encoder(path).ids.limit == pieces.IDS_BYTES


def test_the_encoder_of_token_files_stays_in_its_thread():
    code = (
        "import os, public_tokenizers\n"
        "from windrow.llm import token_files\n"
        "made = token_files.encoder(public_tokenizers.path('byte_bpe_50k.json'))\n"
        "before = len(os.listdir('/proc/self/task'))\n"
        "made.encode(['some words and  odd ones'] * 300)\n"
        "assert len(os.listdir('/proc/self/task')) == before\n"
    )
    clean = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    subprocess.run([sys.executable, "-c", code], env=clean, check=True, timeout=60)
