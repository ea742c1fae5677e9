"""Operators of a training-data pipeline (deduplication, filters, language
identification, language-model scoring, decontamination, packing).

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` uses it.
"""
