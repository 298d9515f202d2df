"""Training-data operators: deduplication, filtering, mixing, packing, archives, media and tokens.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
