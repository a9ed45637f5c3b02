"""Operators for large training corpora; each module holds one of them."""
