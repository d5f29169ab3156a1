"""Landed pages, envelopes, arrays and loaded tables as DataFrames."""
