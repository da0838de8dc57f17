"""Compositions of operators: Silver assembly, Gold build, the gated pipeline
and the mapping of the test tables onto the pipeline's roles."""
