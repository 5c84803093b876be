"""Readers and writers of seeds, rules, pages and results."""
