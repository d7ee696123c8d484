"""No operator of this engine needs state over an unbounded stream; row transforms work on streaming DataFrames as they are."""
