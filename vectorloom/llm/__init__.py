"""Operators that prepare text corpora for language-model training. Nothing outside imports this package."""
