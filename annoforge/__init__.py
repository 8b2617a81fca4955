"""annoforge: governance and evaluation of labelled image annotation data on Spark."""
