"""Tests of the document operators."""
