"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, licenses, lines, minhash, mixing, ngrams, periods, pieces, quality, resampling, search, simhash, warc

Query = Callable[[SparkSession, str], DataFrame]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the vocabulary file is on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _on(f: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])


QUERIES: dict[str, Query] = {
    "op1_top_k_search": _on(search.digest, "documents"),
    "op2_license_scan": _on(licenses.digest, "documents"),
    "op3_line_dedup": _on(lines.digest, "documents"),
    "op4_simhash": _on(simhash.digest, "documents"),
    "op5_warc": _on(warc.digest, "pages"),
    "op6_chat_format": _on(chat.digest, "conversations"),
    "op7_sentencepiece": _on(lambda docs: pieces.digest(docs, model_path()), "documents"),
    "op8_fingerprints": _on(minhash.digest, "documents"),
    "op9_quality": _on(quality.digest, "documents", "labels"),
    "op10_source_mix": _on(mixing.mix, "documents"),
    "op11_lm_score": _on(ngrams.scored, "documents"),
    "op12_importance_resample": _on(resampling.resampled, "documents", "benchmark"),
    "op13_periodic_runs": _on(periods.digest, "documents"),
}

SQL: dict[str, str] = {"op6_chat_format": chat.ORACLE, "op12_importance_resample": resampling.ORACLE}
