"""The queries opN_<name> and what SQL can say about them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprints, langid, merkle, mixing, neardup, packing, repeats, search, secrets, tokens, toxicity, trie
from .common import documents

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": lambda s, d: langid.op1_language(documents(s, d)),
        "op2_packing": lambda s, d: packing.op2_packing(documents(s, d)),
        "op3_mixing": lambda s, d: mixing.op3_mixing(documents(s, d)),
        "op4_search": lambda s, d: search.op4_search(documents(s, d)),
        "op5_secrets": lambda s, d: secrets.op5_secrets(documents(s, d)),
        "op6_fingerprints": lambda s, d: fingerprints.op6_fingerprints(documents(s, d)),
        "op7_toxicity": lambda s, d: toxicity.op7_toxicity(documents(s, d), s.read.parquet(f"{d}/labels.parquet")),
        "op8_jaccard_join": lambda s, d: neardup.op8_jaccard_join(documents(s, d)),
        "op9_repeats": lambda s, d: repeats.op9_repeats(documents(s, d)),
        "op10_token_counts": lambda s, d: tokens.op10_token_counts(documents(s, d), tokenizer_path()),
        "op11_prefix_trie": lambda s, d: trie.op11_prefix_trie(s.read.parquet(f"{d}/conversations.parquet")),
        "op12_bpe": lambda s, d: bpe.op12_bpe(documents(s, d), tokenizer_path()),
        "op13_manifest": lambda s, d: merkle.op13_manifest(documents(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.OP3_SQL, "op4_search": search.OP4_SQL, "op11_prefix_trie": trie.op11_sql(merkle.crc32_sql("conv_id::VARCHAR")), "op13_manifest": merkle.OP13_SQL}
