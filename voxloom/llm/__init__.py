"""Operators of a pipeline for large training corpora. Nothing outside this subpackage imports it."""
