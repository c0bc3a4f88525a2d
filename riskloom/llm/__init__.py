"""Training-data operators: packing, WARC, near-duplicates, PII, quality, mixing, line dedup, secrets.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
