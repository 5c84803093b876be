"""Relational operators of the record pipeline: folds, resolution, scoring, review, export and the crawl frontier."""
