from daystrata.queries.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
