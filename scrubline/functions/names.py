"""Column naming."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    return name.lower().replace(" ", "_")


def snake_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn blanks into underscores.

    One projection for all columns. Two names that become the same are an error
    here, where the cause is plain, rather than an ambiguity later on.
    """
    names = [snake_case(name) for name in df.columns]
    clashes = sorted(name for name, uses in Counter(names).items() if uses > 1)
    if clashes:
        raise ValueError(f"columns {df.columns} collide after renaming: {clashes}")
    return df.toDF(*names)
