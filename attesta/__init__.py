"""Attesta: evidence-gated record resolution and table building on Spark DataFrames."""
