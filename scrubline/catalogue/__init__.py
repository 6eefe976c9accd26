from scrubline.catalogue.oracles import oracle_sql
from scrubline.catalogue.registry import flagship, queries

__all__ = ["flagship", "oracle_sql", "queries"]
