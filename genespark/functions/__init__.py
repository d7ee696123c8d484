"""Column-level functions: intervals, sequences, attributes, genetic codes, text rules."""
