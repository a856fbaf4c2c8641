"""Operators of a training-data pipeline over raw text: deduplication, decontamination, mixing, token files, audits."""
