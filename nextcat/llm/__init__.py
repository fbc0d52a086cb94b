"""Training-data operators: tokenizing, mixing, quality, extraction,
deduplication, language id, chat formatting and exact vector search.

Nothing outside this package (and ``corpus_pipeline.py``) imports it."""
