"""Core queries by name, each over whole tables, and SQL for DuckDB where SQL can state the result."""

from tessella.queries import analysis, chunking, problems, stages, streams

QUERIES: dict = {**chunking.QUERIES, **analysis.QUERIES, **streams.QUERIES, **problems.QUERIES}
SQL: dict[str, str] = {**chunking.SQL, **analysis.SQL, **streams.SQL, **problems.SQL}
