"""Corpus operators: de-duplication, scoring, scanning, tokenising and packing of documents."""
