"""Operators that prepare text corpora and vectors for training, one module each."""
