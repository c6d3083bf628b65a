"""Training-data operators: tokens, quality, packing, filters, fingerprints, shards.

Nothing else in the library imports this subpackage; its queries are in
``planpulse.llm.queries`` and its tests in ``tests/llm``.
"""
