"""Columns of the input under neutral names, so that no name of theirs meets one of an operator's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Aside:
    """df: the input with columns c0, c1 and so on. Operators name their own columns with a leading "_"."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.inner = [f"c{i}" for i in range(len(self.names))]
        self.df = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(self.names, self.inner, strict=True)])

    def __call__(self, name: str) -> Column:
        """The input's column of this name."""
        return F.col(self.inner[self.names.index(name)])

    def back(self, df: DataFrame, *results: str) -> DataFrame:
        """The input's columns under their names, and results; an input column with a result's name gives way."""
        taken = {r.lower() for r in results}
        own = [F.col(c).alias(n) for n, c in zip(self.names, self.inner, strict=True) if n.lower() not in taken]
        return df.select(*own, *results)
