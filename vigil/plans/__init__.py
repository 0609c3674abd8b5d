"""Compositions of operators: training/evaluation runs, drift job, registry."""
