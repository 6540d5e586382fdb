"""The queries of this folder: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from windrow.llm import common, licences, line_dedup, mixing, near_dups, nearest, pieces, quality, repair, secrets, token_files, toxicity, trie, warc
from windrow.session import materialise, work_path


def op1_secret_scan(spark, sf):
    docs = common.table(spark, sf, "documents")
    found = secrets.scan(docs, work_path(spark, "secret-ledger"), ["doc_id"], "text")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    spans = F.array_join(F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def op2_mix_sources(spark, sf):
    mixed = mixing.mix(common.table(spark, sf, "documents"), "doc_id", "source", "text")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_nearest(spark, sf):
    vectors = common.table(spark, sf, "embeddings")
    return nearest.search(vectors, F.col("vec_id") % 20 == 0, "vec_id", "embedding", 20)


def document_path():
    """Documents have no paths: these come from source and id. Document 1234 of src7 is at
    src7/1/12/123/1234, so 12 declares for the directories below src7/1."""
    digits = F.abs("doc_id").cast("string")
    steps = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda k: F.substring(digits, F.lit(1), k))
    return F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.array_join(steps, "/"))


def op4_licences(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", document_path().alias("path"), "text")
    found = licences.scan(docs, "path", "text")
    # The last part of a path is the id.
    number = lambda c: F.substring_index(c, "/", -1).cast("long")
    return found.select(
        number("path").alias("doc_id"), "licence", "similarity", number("declared_by").alias("declared_by"), "inherited"
    )


def op5_quality_rules(spark, sf):
    return quality.judge(common.table(spark, sf, "documents"), "doc_id", "text", ["lang", "source"])


def op6_token_files(spark, sf):
    path = work_path(spark, "token-files")
    docs = common.table(spark, sf, "documents")
    token_files.write(docs, path, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path)


def op7_warc(spark, sf):
    path = work_path(spark, "warc")
    warc.write(common.table(spark, sf, "pages"), path, "page_id", "url", "html")
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_minhash(spark, sf):
    return near_dups.group(common.table(spark, sf, "documents"), "doc_id", "text", near_dups.Similar(3, 85))


def op9_sentencepiece(spark, sf):
    docs = common.table(spark, sf, "documents")
    return digest_ids(pieces.encode(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model")))


def digest_ids(coded):
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_toxicity(spark, sf):
    docs = common.table(spark, sf, "documents")
    model = toxicity.fit(docs, common.table(spark, sf, "labels"))
    return toxicity.score(docs, model, "doc_id", "text")


def op11_prefix_trie(spark, sf):
    rows = common.table(spark, sf, "conversations")
    turns = trie.numbered_turns(rows, "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    turns = trie.shared_openings(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9)
    counts = ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")
    nodes = trie.prefix_trie(turns)
    return nodes.select("conv_id", *[F.col(c).cast("long").alias(c) for c in counts], F.col("saved").alias("saved_tokens"), "ends_sha256")


def op12_conversation_repair(spark, sf):
    rows = common.table(spark, sf, "conversations")
    broken = materialise(repair.damaged(rows, "conv_id", "turn", "role", "text"), "damaged")
    summary, repaired = repair.repair(broken)
    pieces_of = repaired.where("edit <> 'D'").select("conv", "at", "k", F.concat("role", F.lit(":"), "text").alias("piece"))
    digests = common.sha256_of_pieces(pieces_of, "conv", ["at", "k"], "piece", "\n").toDF("conv", "repaired_sha256")
    every = rows.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(summary, "conv", "left").join(digests, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op13_line_dedup(spark, sf):
    kept = line_dedup.dedup(common.table(spark, sf, "documents"), "doc_id", "text")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def catalog():
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_mix_sources": op2_mix_sources,
        "op3_nearest": op3_nearest,
        "op4_licences": op4_licences,
        "op5_quality_rules": op5_quality_rules,
        "op6_token_files": op6_token_files,
        "op7_warc": op7_warc,
        "op8_minhash": op8_minhash,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_toxicity": op10_toxicity,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_line_dedup": op13_line_dedup,
    }
