"""Operators that prepare text for training language models.

Nothing outside this folder imports it; the entry module adds its queries only if it is there.
"""
