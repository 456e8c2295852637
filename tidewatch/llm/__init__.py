"""Training-data operators: filtering, near-duplicates, tokenisation, packing, archives.

Self-contained: nothing outside this folder (and ``corpus_pipeline.py``) imports
it.  Each operator lives in its own module; ``queries`` applies them to whole
tables.
"""
