"""Queries over the tables of a data folder."""

from tidemark.plans import lake_queries, more_queries, pit_queries, relational_queries, report_queries, scalar_queries, source_queries

CATALOGUES = [lake_queries.C, more_queries.C, pit_queries.C, relational_queries.C, report_queries.C, scalar_queries.C, source_queries.C]
