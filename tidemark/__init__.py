"""Attention and market signals as DataFrame functions.

Every operator takes DataFrames and returns a DataFrame. Nothing reads the
clock: whatever depends on the current time takes ``as_of``.
"""
