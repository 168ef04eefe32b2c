"""Readers and writers at the edges: text tables in, Parquet inside, report files out."""
