"""Operators on spoken-word recordings and their transcripts, as Spark DataFrame functions."""
