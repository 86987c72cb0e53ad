"""Spark-native curation engine for document-parsing corpora.

Everything is a DataFrame-to-DataFrame function; nothing here starts a
session on import.
"""

__version__ = "0.1.0"
