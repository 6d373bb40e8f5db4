"""Training-data operators: archives, sharding, token files, near duplicates, packing, mixing, fingerprints.

Nothing outside this subpackage imports it, except the guarded registration in ``__spark_entry__.py``
and ``corpus_pipeline.py``.
"""
