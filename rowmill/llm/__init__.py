"""Operators for preparing language-model training data, one module each.

``quality``, ``line_dedup``, ``ngram_join``, ``pii``, ``packing``, ``nn_descent``,
``langid``, ``token_scan``, ``bpe`` and ``pivot_topk``.  ``registry`` holds their
queries.  Nothing else in the library imports this subpackage.
"""
