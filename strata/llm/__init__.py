"""Operators for large training corpora (imported by nothing else in the library)."""
