"""Corpus operators for training-data pipelines: dedup, search, filtering,
decontamination, tokenised output and packing over whole document tables.

Nothing else in the library imports this package."""
