"""Queries of the training-data operators, each over its whole table, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from playtally.llm import alignment, chat, decontaminate, kernel_quality, language, licenses, neardup, pieces, pii, prefix_trie, quality, repeats, secrets


def queries() -> dict[str, Callable]:
    return {
        "op1_chat_format": chat.chat_format,
        "op2_secret_scan": secrets.secret_scan,
        "op3_quality_rules": quality.quality_rules,
        "op4_sentencepiece_nbest": pieces.sentencepiece_nbest,
        "op5_minhash_neardup": neardup.minhash_neardup,
        "op6_suffix_dedup": repeats.suffix_dedup,
        "op7_decontaminate": decontaminate.decontaminate,
        "op8_language_id": language.language_id,
        "op9_license_scan": licenses.license_scan,
        "op10_pii": pii.pii,
        "op11_prefix_trie": prefix_trie.conversation_trie,
        "op12_cross_tokenizer_alignment": alignment.cross_tokenizer_alignment,
        "op13_quality_classifier": kernel_quality.quality_classifier,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat.SQL,
        "op3_quality_rules": quality.SQL,
        "op5_minhash_neardup": neardup.SQL,
        "op7_decontaminate": decontaminate.SQL,
        "op9_license_scan": licenses.SQL,
        "op11_prefix_trie": prefix_trie.SQL,
    }
