"""The registered queries of this subpackage and their DuckDB twins, where SQL can express them."""

import public_tokenizers

from tripflow.llm import (
    byte_bpe,
    classifier,
    jaccard,
    licenses,
    line_quality,
    packing,
    prefix_trie,
    secrets,
    shards,
    spelling,
    token_blocks,
    topk,
    url_graph,
)
from tripflow.llm.oracles import ORACLES as _ORACLES
from tripflow.llm.oracles_groups import ORACLES as _GROUP_ORACLES

__all__ = ["ORACLES", "QUERIES"]

ORACLES = {**_ORACLES, **_GROUP_ORACLES}

BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def op1_url_graph(spark, sf_dir):
    return url_graph.judge_urls(_table(spark, sf_dir, "pages"))


def op2_secret_scan(spark, sf_dir):
    return secrets.secret_report(_documents(spark, sf_dir))


def op3_line_quality(spark, sf_dir):
    return line_quality.quality_report(_documents(spark, sf_dir))


def op4_token_blocks(spark, sf_dir):
    return token_blocks.token_digests(_documents(spark, sf_dir), public_tokenizers.path(BYTE_TOKENIZER))


def op5_interleaved_shards(spark, sf_dir):
    return shards.shard_report(_documents(spark, sf_dir))


def op6_top_products(spark, sf_dir):
    return topk.top_report(_table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark, sf_dir):
    return jaccard.join_components(_documents(spark, sf_dir))


def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path(BYTE_RANKS))


def op9_quality_classifier(spark, sf_dir):
    return classifier.quality_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op10_packing(spark, sf_dir):
    return packing.packed_pieces(_documents(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER))


def op11_license_join(spark, sf_dir):
    return licenses.license_report(_documents(spark, sf_dir))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variant_report(_documents(spark, sf_dir))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie_report(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_graph, op2_secret_scan, op3_line_quality, op4_token_blocks, op5_interleaved_shards,
        op6_top_products, op7_jaccard_join, op8_byte_bpe, op9_quality_classifier, op10_packing,
        op11_license_join, op12_spelling_variants, op13_prefix_trie,
    )
}
