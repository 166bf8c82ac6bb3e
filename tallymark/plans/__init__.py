"""Compositions of operators: training table, preprocessing, prediction, evaluation."""
