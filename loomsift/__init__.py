"""Loomsift: a corpus curation engine on PySpark."""
