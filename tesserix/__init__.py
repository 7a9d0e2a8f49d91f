"""Tesserix: provenance-gated extraction analytics as PySpark relations."""
