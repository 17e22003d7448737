"""Training-data operators for very large corpora.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and ``corpus_pipeline.py`` at the repository top chains five of them.
"""
