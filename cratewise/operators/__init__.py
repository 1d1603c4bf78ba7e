"""Operators over catalogue DataFrames."""
