"""Captured pages as a Spark data source, and the registry of sources.

``spark.read.format("captured_pages").option("path", ...)`` deals the row groups
of a folder of Parquet pages out to tasks and yields (source_id, url, html). The
option ``source_id`` reads one source only. (Filters are not pushed into the
reader: a table that is scanned twice shares one, and the second filter would
hold for both scans.) Live HTTP stays off.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PageReader(DataSourceReader):
    def __init__(self, path: str, source: str | None):
        self.path, self.source = path, source

    def partitions(self) -> list[InputPartition]:
        import pyarrow.dataset as ds

        found = ds.dataset(self.path, format="parquet").get_fragments()
        return [InputPartition((f.path, g.id)) for f in sorted(found, key=lambda f: f.path) for g in f.row_groups]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        file, group = partition.value
        wanted = None if self.source is None else pc.field("source_id") == self.source
        (fragment,) = ds.dataset(file, format="parquet").get_fragments()
        yield from fragment.subset(row_group_ids=[group]).to_batches(columns=["source_id", "url", "html"], filter=wanted)


class CapturedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured_pages"

    def schema(self) -> str:
        return "source_id string, url string, html string"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], self.options.get("source_id"))


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(CapturedPages)


Search = Callable[..., DataFrame]


class Registry:
    """Sources by id. A later registration of an id takes the place of an earlier one."""

    def __init__(self):
        self._found: dict[str, tuple[str, Search]] = {}

    def add(self, source: str, mode: str, search: Search) -> None:
        if mode not in ("query", "walk"):
            raise ValueError(f"unknown mode {mode}")
        self._found[source] = mode, search

    def available(self) -> list[str]:
        return list(self._found)

    def search(self, spark: SparkSession, source: str, query: str, **limits) -> DataFrame:
        """Records of one source; ``limits`` (year_from, year_to) go to its search."""
        if source not in self._found:
            raise KeyError(source)
        return self._found[source][1](spark, query, **limits)

    def search_all(self, spark: SparkSession, names: list[str], query: str, **limits) -> DataFrame:
        """Union of the sources' records; an unknown name is an error before anything runs."""
        if unknown := sorted(set(names) - set(self._found)):
            raise KeyError(", ".join(unknown))
        first, *rest = [self.search(spark, n, query, **limits) for n in names]
        for df in rest:
            first = first.unionByName(df, allowMissingColumns=True)
        return first
