"""Compositions of operators: business views, reports and the query registry."""
