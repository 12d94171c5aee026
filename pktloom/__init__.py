"""Packet, flow and capture analytics expressed as Spark DataFrames."""
