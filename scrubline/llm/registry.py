"""The registered queries of this subpackage, in one place."""

from __future__ import annotations

from scrubline.llm import chat, embeddings, grammar, langid, licenses, media, merkle, mixing, negatives, packing, simhash, substrings, urls


def queries() -> dict:
    return {
        "op1_license_scan": licenses.op1_license_scan,
        "op2_mix_sources": mixing.op2_mix_sources,
        "op3_pack_documents": packing.op3_pack_documents,
        "op4_embedding_duplicates": embeddings.op4_embedding_duplicates,
        "op5_language_id": langid.op5_language_id,
        "op6_media_columns": media.op6_media_columns,
        "op7_format_chats": chat.op7_format_chats,
        "op8_filter_urls": urls.op8_filter_urls,
        "op9_substring_dedup": substrings.op9_substring_dedup,
        "op10_simhash_duplicates": simhash.op10_simhash_duplicates,
        "op11_token_files": grammar.op11_token_files,
        "op12_dataset_manifest": merkle.op12_dataset_manifest,
        "op13_hard_negatives": negatives.op13_hard_negatives,
    }


def oracle_sql() -> dict:
    return {
        "op2_mix_sources": mixing.OP2_SQL,
        "op7_format_chats": chat.OP7_SQL,
        "op8_filter_urls": urls.OP8_SQL,
        "op9_substring_dedup": substrings.OP9_SQL,
        "op12_dataset_manifest": merkle.OP12_SQL,
        "op13_hard_negatives": negatives.OP13_SQL,
    }
