"""Compositions of operators: the data and artwork pipelines, registered queries, the command line."""
