"""The stages' decisions against brute force, stage by stage."""

import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from test_near_dups import brute
from windrow.llm import secrets, toxicity
from windrow.session import materialise, work_path


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "secrets", "mixing", "encoding"]
    stored = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf), "stage")
        stored.append(docs)
        if len(stored) < 5:
            assert docs.columns == list(next(iter(before.values())).__fields__)

    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    grammar = toxicity.Grammar(model.lexicon)
    import numpy as np

    calm = {i for i, r in before.items() if model.scores(np.array([grammar.features(r.text or "")]))[0] < 0.5}
    assert {r.doc_id for r in stored[0].collect()} == calm

    rows = [(i, before[i].text) for i in sorted(calm)]
    assert {str(r.doc_id) for r in stored[1].collect()} == {i for i, _, c in brute(rows, 5, 80) if i == c}

    found = secrets.scan(stored[1], work_path(spark, "ledger"), ["doc_id"], "text").collect()
    spans = {r.doc_id: r.findings for r in found}
    clean = {r.doc_id: r for r in stored[2].collect()}
    assert set(clean) == set(spans)
    for i, r in clean.items():
        assert (r.text == before[i].text) == (not spans[i]) and (not spans[i] or r.n_chars == len(r.text))
    again = secrets.scan(stored[2], work_path(spark, "ledger"), ["doc_id"], "text").collect()
    assert not [r for r in again if r.findings]

    mixed = stored[3].collect()
    assert {r.doc_id for r in mixed} <= set(clean) and all(r.text == clean[r.doc_id].text for r in mixed)

    plain = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in mixed:
        ids = plain.encode(r.text or "")
        shas = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), plain.decode(ids))]
        want.append((r.doc_id, len(ids), *shas))
    assert sorted(tuple(r) for r in stored[4].collect()) == sorted(want)
    assert sorted(corpus_pipeline.run(spark, sf).columns) == sorted(stored[4].columns)
