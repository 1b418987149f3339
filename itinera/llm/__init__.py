"""Operators of a training-data pipeline (PII, sharding, language id, licences,
decontamination, near and exact duplicates, nearest neighbours, SentencePiece,
quality).  Nothing else in the library imports this package."""
