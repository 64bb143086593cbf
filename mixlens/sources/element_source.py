"""The element table as a Spark data source, readable by name.

``register(spark)`` once; then ``spark.read.format("mixlens_elements").load()``. Options: ``first`` and ``last`` atomic
number, ``partitions`` (tasks that make the rows). A source of one's own is a subclass of ``KeyedRowsSource`` with a name, a
schema and ``rows_of(key)``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from mixlens.sources import elements

# Executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(elements)


class Keys(InputPartition):
    """Keys first..last-1, one task's share."""

    def __init__(self, first: int, last: int) -> None:
        super().__init__((first, last))
        self.first, self.last = first, last


class KeyedRowsSource(DataSource):
    """Rows made from a run of whole-number keys, dealt out evenly over the tasks."""

    #: First and last key if the options name none.
    KEYS = (1, 0)

    def rows_of(self, key: int) -> Iterator[tuple]:
        raise NotImplementedError

    def reader(self, schema: StructType) -> DataSourceReader:
        return KeyedRowsReader(self)


class KeyedRowsReader(DataSourceReader):
    def __init__(self, source: KeyedRowsSource) -> None:
        self.source = source
        low, high = source.KEYS
        self.first, self.last = int(source.options.get("first", low)), int(source.options.get("last", high))
        if not low <= self.first or not self.last <= high:
            raise ValueError(f"keys must lie in {low}..{high}")
        self.tasks = max(1, int(source.options.get("partitions", 1)))

    def partitions(self) -> list[InputPartition]:
        n = max(0, self.last - self.first + 1)
        ends = [self.first + n * i // self.tasks for i in range(self.tasks + 1)]
        return [Keys(a, b) for a, b in zip(ends, ends[1:]) if a < b] or [Keys(0, 0)]

    def read(self, partition: Keys) -> Iterator[tuple]:
        for key in range(partition.first, partition.last):
            yield from self.source.rows_of(key)


class ElementSource(KeyedRowsSource):
    """(component, electronic_configuration) of the elements."""

    KEYS = (1, elements.MAX_Z)

    @classmethod
    def name(cls) -> str:
        return "mixlens_elements"

    def schema(self) -> StructType:
        return elements.ELEMENT_SCHEMA

    def rows_of(self, key: int) -> Iterator[tuple]:
        yield key, elements.electron_configuration(key)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ElementSource)
