from tickloom.catalog.oracles import oracle_sql
from tickloom.catalog.registry import flagship, queries

__all__ = ["flagship", "oracle_sql", "queries"]
