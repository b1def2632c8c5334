"""Whole alignments, composed of the operators."""
