"""Maskwright: find, replace and verify sensitive content in large corpora with Spark."""
