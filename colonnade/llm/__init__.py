"""Operators of a training-data pipeline: language ID, license scans, repeated-text removal,
language-model scores, near and exact duplicates, decontamination, token files, packing, toxicity.

Nothing else in the library imports this package.
"""
