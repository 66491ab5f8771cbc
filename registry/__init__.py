"""Queries over the given tables, one module per topic."""

from registry import catalogue_queries, model_queries, service_queries, space_queries, text_queries, vector_queries

MODULES = (vector_queries, space_queries, text_queries, catalogue_queries, model_queries, service_queries)
