"""The operators bound to the supplied tables, one query each, with SQL where SQL can state the result."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chat import digests, log_of, messages, rendered
from millrace.llm.common import stage
from millrace.llm.hmm import scored
from millrace.llm.html_blocks import extracted, trained
from millrace.llm.language import dictionaries, fold, identified
from millrace.llm.lexical import ranked_documents
from millrace.llm.line_dedup import without_shared_lines
from millrace.llm.merkle import proved
from millrace.llm.mixing import mixture
from millrace.llm.oracles import CHAT, LINES, MERKLE, OVERLAPS, QUALITY, SEARCH
from millrace.llm.quality import measured, rungs_for, verdicts
from millrace.llm.simhash import near_duplicate_groups
from millrace.llm.spaced_seeds import contaminated
from millrace.llm.suffix_dedup import without_repeats
from millrace.llm.token_store import document_digests
from millrace.sources.tables import fixture

# A public tokenizer's file; another place is given by this variable.
TOKENIZER = os.environ.get("MILLRACE_TOKENIZER", "word_bpe_49k.json")


def tokenizer_path() -> str:
    """Where the tokenizer's file lies: a path as it is, a plain name among the installed public tokenizers."""
    if os.sep in TOKENIZER:
        return TOKENIZER
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the coded files."""
    return document_digests(fixture(spark, sf_dir, "documents"), tokenizer_path())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document; cutoffs from the labels, one rung per language."""
    measures = stage(measured(fixture(spark, sf_dir, "documents")), "quality-measures")
    judged = verdicts(measures, rungs_for(measures, fixture(spark, sf_dir, "labels")))
    counts = [F.col(f"measures.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept")


# A conversation that says control strings, as in the template of another model.
TRICKY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their rendered form."""
    conversations = fixture(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(TRICKY, "conv_id bigint, turn bigint, role string, text string")
    return digests(rendered(messages(log_of(conversations.unionByName(more)))))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document, links at 4 or fewer differing bits."""
    groups = near_duplicate_groups(fixture(spark, sf_dir, "documents"), distance=4, shingle=4)
    return groups.select("doc_id", "fingerprint", "component_id")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = fixture(spark, sf_dir, "pages")
    return extracted(pages, trained(pages))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stay in every document, as counts and a digest."""
    docs = fixture(spark, sf_dir, "documents")
    return without_shared_lines(docs, min_chars=40, min_docs=5, digest=True)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document; six of seven folds train the model."""
    held_out = fold(F.col("doc_id"), 7) == 2
    found = scored(fixture(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes from every document."""
    mix = mixture(fixture(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds a passage."""
    return contaminated(fixture(spark, sf_dir, "documents"), fixture(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; dictionaries come from two thirds of the documents."""
    docs = fixture(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    contents = dictionaries(docs.filter(~held_out).select("text", "lang"))
    return identified(docs, contents).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return ranked_documents(fixture(spark, sf_dir, "documents"), fixture(spark, sf_dir, "benchmark"), top=20)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verdict of every document; of every other one the line breaks are gone when it is verified."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(touched, F.translate("text", "\n", ""))
    return proved(fixture(spark, sf_dir, "documents"), tampered)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of repeated 400-byte strings."""
    return without_repeats(fixture(spark, sf_dir, "documents"), length=400, digest=True)


QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_mixing": op8_mixing,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_language_id": op10_language_id,
    "op11_lexical_search": op11_lexical_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_suffix_dedup": op13_suffix_dedup,
}

# The others have no SQL; tests/llm compares them with brute force.
ORACLES = {
    "op2_quality_rules": QUALITY,
    "op3_chat_formatting": CHAT,
    "op6_line_dedup": LINES,
    "op9_benchmark_decontamination": OVERLAPS,
    "op11_lexical_search": SEARCH,
    "op12_merkle_manifest": MERKLE,
}
