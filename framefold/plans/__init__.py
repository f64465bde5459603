"""Compositions of the operators: the batch flow and the registered queries."""
