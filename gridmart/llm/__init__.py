"""Operators of a training-data pipeline over ``documents``, ``benchmark`` and ``conversations``.

Nothing outside this folder, its tests and ``corpus_pipeline.py`` imports it.
"""
