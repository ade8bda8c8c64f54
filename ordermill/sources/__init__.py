"""Readers of order files and the raw envelope."""
