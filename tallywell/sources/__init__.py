"""Readers of invoice lines and metric samples."""
