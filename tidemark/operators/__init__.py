"""Operators over advertiser, lead, contact and deal tables: each takes and returns DataFrames."""
