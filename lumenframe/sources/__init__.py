"""Readers, writers and reshaping of nested or matrix input."""
