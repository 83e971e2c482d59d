"""Readers, writers and the table mappings the registered queries run on."""
