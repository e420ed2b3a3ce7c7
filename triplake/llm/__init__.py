"""Operators for large-scale text corpora: filtering, de-duplication, decontamination, encoding and scoring."""
