"""Whole plans: the gold mart and the bronze-to-gold run."""
