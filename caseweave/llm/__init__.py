"""Operators that prepare text for training: cleaning, selection, mixing and output."""
