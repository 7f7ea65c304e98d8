"""Operators for preparing text corpora: extraction, filtering, near-duplicate
removal, decontamination, tokenisation and packing. Nothing outside this
subpackage imports it."""
