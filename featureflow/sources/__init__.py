"""Readers, writers and feature tables."""
