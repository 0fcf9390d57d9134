"""The queries of the operators for training corpora, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tideline.llm import chat, fertility, fmindex, hyperminhash, kdtree, kneser_ney, langid, merkle, ownership, repair, runindex, setjoin, tree_bpe
from tideline.llm.common import table
from tideline.llm.oracle import LOWER, ORACLE, UPPER  # noqa: F401  (the entry point reads ORACLE)

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def hex_digest(column):
    return F.sha2(column, 256)


@query
def op1_secret_ownership(spark, sf_dir):
    """A repository is a source's documents of one language; its owner is the source."""
    found = ownership.judged(
        table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"), ["doc_id"]
    )
    live = F.filter("spans", lambda m: m["live"])
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        hex_digest(ownership.span_text("base")).alias("base_sha256"),
        ownership.span_text("spans").alias("spans"),
        F.size(live).cast("long").alias("n_live"),
    )


@query
def op2_kd_shards(spark, sf_dir):
    shards = kdtree.document_shards(table(spark, sf_dir, "documents"), leaves=8)
    return shards.select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_language_masks(spark, sf_dir):
    found = langid.held_out(table(spark, sf_dir, "documents"))
    return found.select("keys.doc_id", "keys.held_out", "lang_pred", "score")


@query
def op4_token_fertility(spark, sf_dir):
    found = fertility.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "keys.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_kneser_ney(spark, sf_dir):
    found, model = kneser_ney.held_out(table(spark, sf_dir, "documents"))
    return found.select(
        "keys.doc_id", "keys.held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


@query
def op6_tree_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = tree_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "keys.doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        hex_digest("ids").alias("ids_sha256"),
        hex_digest("decoded").alias("decoded_sha256"),
    )


@query
def op7_chat_events(spark, sf_dir):
    """The table's turns as streamed events, and conversation -7, whose texts are control strings."""
    planted = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    done = chat.render(chat.fold_events(chat.streamed(turns)))
    back = done.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"),
    )
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), hex_digest(shown).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), hex_digest("learned").alias("loss_sha256"), "formatted_chars",
    )


@query
def op8_hyperminhash(spark, sf_dir):
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op9_fm_decontamination(spark, sf_dir):
    found = fmindex.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "keys.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


@query
def op10_run_index(spark, sf_dir):
    done = runindex.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return done.select(
        "keys.doc_id", (F.octet_length("kept") + n_removed).alias("n_bytes"), n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), hex_digest("kept").alias("kept_sha256"),
    )


@query
def op11_suffix_repair(spark, sf_dir):
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repaired(rows, F.col("present")).select("conv_id", *repair.COUNTS, "cost", "audit", "repaired_sha256")


@query
def op12_merkle_manifest(spark, sf_dir):
    """Every fifth document by its id's crc32 is held against its proof with its capitals made small."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed)
    return found.select(
        "doc_id", "leaf", "subroot", "root", hex_digest(merkle.proof_text(F.col("proof"))).alias("proof_sha256"),
        merkle.folded(F.col("changed_leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_size_aware_join(spark, sf_dir):
    found = setjoin.linked_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
