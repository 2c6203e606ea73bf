"""Training-data operators: quality, dedup, decontamination, privacy, packing, scoring.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
