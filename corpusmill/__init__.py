"""corpusmill: text, link-graph, labelled-table and ordered-sequence jobs on Spark DataFrames."""

__version__ = "0.1.0"
