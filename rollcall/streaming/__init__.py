"""Micro-batch versions of the scoring job."""
