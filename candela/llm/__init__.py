"""Training-data operators and the corpus pipeline's queries.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` and the
driver entry point add its queries.
"""
