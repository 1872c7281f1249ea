"""Operators for preparing training text. Nothing outside this folder, `tests/llm` and `corpus_pipeline.py` imports them."""
