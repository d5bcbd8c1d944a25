"""Readers, writers and declared table layouts."""
