"""Operators of a training-data pipeline: near-duplicates, language-model
scoring, packing, toxicity, document fingerprints, quality rules, quality
classification, token counts, sampled segmentations, URL filters, exact
duplicates, a prefix trie of conversations and an audit of filters.

Nothing else in the library imports this subpackage.
"""
