"""Compositions of operators over stored stages."""
