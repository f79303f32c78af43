"""The operators bound to the test tables, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardloom.llm import decontaminate, language_id, masked_lm, minhash, ngram_quality, oracles, packing, periodic_runs, pii, quality_rules, spelling, token_counts, token_files, warc
from cardloom.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_of(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), typo_every=199)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.with_repeats(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_warc": op3_warc,
    "op4_minhash": op4_minhash,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_token_files": op11_token_files,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Without SQL: trained models (2, 5, 7, 10) and token ids of a library (8, 9).
ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.OP1,
    "op3_warc": oracles.OP3,
    "op4_minhash": oracles.OP4,
    "op6_decontamination": oracles.OP6,
}
