"""Operators for building training data: one module per operator, and ``queries`` that applies them.

Nothing outside this folder imports it; deleting the folder (with ``corpus_pipeline.py`` and
``tests/llm``) leaves the rest of the library whole.
"""
