"""Probabilistic record linkage (Fellegi-Sunter) as Spark jobs over a table of candidate pairs."""
