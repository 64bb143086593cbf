"""Persistable ML stages for composition features.

``CompositionStats`` is a ``Transformer`` with ``Params``, so a ``Pipeline``
holding it can be saved and loaded like any Spark ML pipeline. The property
table is small and bounded (one value per component); it is stored in the
stage as a JSON param, read once when the stage is built.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from mixlens.operators.composition import property_values, wide_stats_from_values
from mixlens.operators.properties import forward_fill


class CompositionStats(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add ``<property>_<stat>`` columns from one weight column per component."""

    componentCols = Param(Params._dummy(), "componentCols",
                          "weight columns (named by component id unless componentIds is set)",
                          TypeConverters.toListString)
    componentIds = Param(Params._dummy(), "componentIds",
                         "component id of each weight column, aligned with componentCols",
                         TypeConverters.toListInt)
    propertyCols = Param(Params._dummy(), "propertyCols", "property names", TypeConverters.toListString)
    propertyTable = Param(Params._dummy(), "propertyTable",
                          "JSON {property: {component: value}}", TypeConverters.toString)
    normalize = Param(Params._dummy(), "normalize", "divide mean and spread by the weight total",
                      TypeConverters.toBoolean)
    asFloat = Param(Params._dummy(), "asFloat", "cast results to 32-bit float", TypeConverters.toBoolean)
    nullWeight = Param(Params._dummy(), "nullWeight", "NULL and NaN weights: 'zero' counts them as 0, 'error' stops the job",
                       TypeConverters.toString)

    @keyword_only
    def __init__(self, *, componentCols=None, componentIds=None, propertyCols=None, propertyTable=None,
                 normalize=False, asFloat=False, nullWeight="zero"):
        super().__init__()
        self._setDefault(normalize=False, asFloat=False, nullWeight="zero")
        self._set(**self._input_kwargs)

    @classmethod
    def from_table(cls, props: DataFrame, property_cols, component_cols, **kw) -> "CompositionStats":
        """Build the stage from a (bounded) property DataFrame keyed by ``component``.

        ``component_cols`` lists weight columns named by component id, or maps
        component id -> column name.
        """
        _, values = property_values(props, property_cols)
        return cls.from_values(values, property_cols, component_cols, **kw)

    @classmethod
    def from_values(cls, values, property_cols, component_cols, **kw) -> "CompositionStats":
        """Build the stage from property values already read (``{prop: {component: value}}``),
        e.g. to make one stage per property from a single read of the table."""
        if isinstance(component_cols, dict):
            kw = {**kw, "componentIds": [int(k) for k in component_cols]}
            component_cols = list(component_cols.values())
        table = {p: {str(k): (None if v is None or (isinstance(v, float) and math.isnan(v)) else v)
                     for k, v in values[p].items()} for p in property_cols}
        return cls(componentCols=list(component_cols), propertyCols=list(property_cols),
                   propertyTable=json.dumps(table), **kw)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = json.loads(self.getOrDefault(self.propertyTable))
        values = {p: {int(k): v for k, v in vals.items()} for p, vals in table.items()}
        cols = self.getOrDefault(self.componentCols)
        if self.isDefined(self.componentIds):
            cols = dict(zip(self.getOrDefault(self.componentIds), cols))
        return wide_stats_from_values(dataset, cols, values,
                                      self.getOrDefault(self.propertyCols),
                                      normalize=self.getOrDefault(self.normalize),
                                      as_float=self.getOrDefault(self.asFloat), null_weight=self.getOrDefault(self.nullWeight))


class CompositionStatsModel(CompositionStats, Model):
    """What ``CompositionStatsFit`` has fitted: the stage with the (filled) property values it read."""


class CompositionStatsFit(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """R1 + A9 as an estimator: ``fit`` reads the property table and fills its gaps, the model holds the values.

    The property table is named by its Parquet path, so that the estimator can be saved and loaded in a
    ``Pipeline`` before it is fitted. With ``fill`` a gap takes the value of the component before it in the whole
    table, not only among the weight columns.
    """

    propertyPath = Param(Params._dummy(), "propertyPath", "Parquet path of the property table", TypeConverters.toString)
    componentKey = Param(Params._dummy(), "componentKey", "its column of component ids", TypeConverters.toString)
    fill = Param(Params._dummy(), "fill", "fill gaps from the component before", TypeConverters.toBoolean)
    componentCols, componentIds, propertyCols = (getattr(CompositionStats, p) for p in ("componentCols", "componentIds", "propertyCols"))
    normalize, asFloat, nullWeight = (getattr(CompositionStats, p) for p in ("normalize", "asFloat", "nullWeight"))

    @keyword_only
    def __init__(self, *, propertyPath=None, componentKey="component", fill=False, componentCols=None, componentIds=None,
                 propertyCols=None, normalize=False, asFloat=False, nullWeight="zero"):
        super().__init__()
        self._setDefault(componentKey="component", fill=False, normalize=False, asFloat=False, nullWeight="zero")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CompositionStatsModel:
        key, names = self.getOrDefault(self.componentKey), self.getOrDefault(self.propertyCols)
        cols = self.getOrDefault(self.componentCols)
        table = dataset.sparkSession.read.parquet(self.getOrDefault(self.propertyPath)).select(key, *names)
        if self.getOrDefault(self.fill):
            table = forward_fill(table, names, key)
        ids = self.getOrDefault(self.componentIds) if self.isDefined(self.componentIds) else [int(c) for c in cols]
        _, values = property_values(table.where(table[key].isin(ids)), names, key)
        kept = {p: self.getOrDefault(getattr(self, p)) for p in ("normalize", "asFloat", "nullWeight")}
        model = CompositionStatsModel.from_values(values, names, dict(zip(ids, cols)), **kept)
        return model.setParent(self) if hasattr(model, "setParent") else model
