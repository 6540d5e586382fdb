import hashlib
import re

from windrow.llm import secrets
from windrow.session import work_path

CASES = [
    ("token=abcdefgh", [("assign", 0, 14)]),
    ("token=abcdefg", []),
    ('x API_KEY": "aaaa/bbbb+c=" apikey:zzzzzzzz', [("assign", 2, 25), ("assign", 27, 42)]),
    # A match that is too short still takes its characters.
    ("password=token:abcdefghij", []),
    ("ſecret=abcdefgh paſsword=abcdefgh", []),
    ("é🙂 AKIAABCDEFGHIJKL AKIAABCDEFGHIJK", [("access", 3, 19)]),
    ("f" * 31 + " " + "0" * 32, [("hex", 32, 64)]),
    ("secret=" + "a" * 40, [("assign", 0, 47), ("hex", 7, 47)]),
    ("", []),
    (None, []),
]


def spans(row):
    return [(f.kind, f.start, f.end) for f in row.findings]


def test_cases_copies_and_paths(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] * 2
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = secrets.scan(df, work_path(spark, "ledger"), ["doc_id"], "text").collect()
    assert len(got) == len(rows)
    assert all(spans(r) == CASES[r.doc_id][1] for r in got)


def test_ledger_scans_only_what_is_new(spark):
    ledger = work_path(spark, "ledger")
    first = spark.createDataFrame([(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, "plain")], "path int, text string")
    secrets.update_ledger(first, ledger, "text")
    assert secrets.read_ledger(spark, ledger).count() == 2
    second = spark.createDataFrame([(4, "plain"), (5, "token=ijklmnop")], "path int, text string")
    got = {r.path: spans(r) for r in secrets.scan(second, ledger, ["path"], "text").collect()}
    assert got == {4: [], 5: [("assign", 0, 14)]}
    assert secrets.read_ledger(spark, ledger).count() == 3
    # A rule of a new version is tried on known contents, the others are not tried again.
    newer = [r for r in secrets.RULES if r.kind != "hex"] + [secrets.Rule("hex", 2, "[0-9a-f]+", 4)]
    got = {r.path: spans(r) for r in secrets.scan(first, ledger, ["path"], "text", newer).collect()}
    assert got[1] == [("assign", 0, 14), ("hex", 6, 12)] and got[3] == []
    added = secrets.read_ledger(spark, ledger).where("array_contains(rules, 'hex@2')").collect()
    assert {tuple(r.rules) for r in added} == {("hex@2",)} and len(added) == 2
    assert hashlib.sha256(b"plain").hexdigest() in {r.blob for r in added}


def test_a_run_without_news_moves_no_text(spark, monkeypatch):
    ledger = work_path(spark, "ledger")
    rows = spark.createDataFrame([(i, f"text {i % 50} token=abcdefgh{i % 50}") for i in range(200)], "path int, text string")
    secrets.update_ledger(rows, ledger, "text")
    asked = []
    monkeypatch.setattr(secrets, "_scanner", lambda rules: asked.append(rules))
    secrets.update_ledger(rows, ledger, "text")
    assert not asked and secrets.read_ledger(spark, ledger).count() == 50


def test_many_new_contents_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(secrets, "FEW", 3)
    rows = spark.createDataFrame([(i, f"text {i % 50} token=abcdefgh{i % 50}") for i in range(200)], "path int, text string")
    got = secrets.scan(rows, work_path(spark, "ledger"), ["path"], "text").collect()
    assert len(got) == 200 and all(len(r.findings) == 1 for r in got)


def test_odd_rows_and_empty_table(spark, odd, none):
    got = secrets.scan(odd, work_path(spark, "ledger"), ["doc_id", "rank"], "text")
    assert got.columns == ["doc_id", "rank", "findings"] and got.count() == odd.count()
    found = {r.doc_id: spans(r) for r in got.collect() if r.findings}
    assert found == {10: [("assign", 0, 15), ("access", 36, 62), ("hex", 52, 100)]}
    assert secrets.scan(none, work_path(spark, "ledger"), ["doc_id"], "text").count() == 0


def test_redact(spark):
    texts = ["a token=abcdefgh b", "secret=" + "a" * 40, "none", None, "AKIAABCDEFGHIJKL"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = secrets.scan(df, work_path(spark, "ledger"), ["doc_id"], "text")
    got = found.join(df, "doc_id").select("doc_id", secrets.redact("text").alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {0: "a [REDACTED] b", 1: "[REDACTED]", 2: "none", 3: None, 4: "[REDACTED]"}


def test_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: spans(r) for r in secrets.scan(docs, work_path(spark, "ledger"), ["doc_id"], "text").collect()}
    for r in docs.collect():
        t, want = r.text or "", []
        for i, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32))):
            want += [(m.start(), i + 1, m.end(), kind) for m in re.finditer(pattern, t) if len(m[0]) >= least]
        assert [s for s in got[r.doc_id] if s[0] != "assign"] == [(k, a, b) for a, _, b, k in sorted(want)]
