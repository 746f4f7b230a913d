"""Importing this module registers the queries of all operators."""

import corpus_pipeline  # noqa: F401
from linkcat.llm import chat, curriculum, divergence, minhash, ordinal, posting_lists, prefix_trie, sentencepiece_viterbi, superkmer, token_counts, toxicity, url_rules, wu_manber  # noqa: F401
from linkcat.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
