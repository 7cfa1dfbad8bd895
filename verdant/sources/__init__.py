"""Readers with explicit schemas (no schema inference on large inputs)."""
