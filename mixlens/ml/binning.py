"""Equal-width bins fitted on one table and applied to others."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.operators.binning import bin_label, target_range

OUTSIDE = ("end", "null", "error")


class _BinParams(HasInputCol, HasOutputCol):
    outside = Param(Params._dummy(), "outside", "values outside the fitted range: 'end' gives the label of the end bin on "
                    "their side, 'null' none (or nullLabel), 'error' stops the job", TypeConverters.toString)
    nullLabel = Param(Params._dummy(), "nullLabel", "label of NULL and NaN, and of values left without one", TypeConverters.toString)

    def _checked(self) -> str:
        how = self.getOrDefault(self.outside)
        if how not in OUTSIDE:
            raise ValueError(f"outside must be one of {OUTSIDE}, not {how!r}")
        return how


class EqualWidthBinnerModel(Model, _BinParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the label '0'..'n-1' of the fitted bins [edge_k, edge_k+1), the last one closed."""

    edges = Param(Params._dummy(), "edges", "the n + 1 edges, ascending; none if no finite value was seen", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, edges=None, outside="end", nullLabel=None):
        super().__init__()
        self._setDefault(outside="end")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _label(self, x: Column) -> Column:
        edges, how = self.getOrDefault(self.edges), self._checked()
        if not edges:
            return F.lit(None).cast("string")
        lo, hi = F.lit(edges[0]), F.lit(edges[-1])
        known = x.isNotNull() & ~F.isnan(x)
        if how == "end":
            x = F.least(F.greatest(x, lo), hi)
        label = F.when(known, bin_label(x, [F.lit(e) for e in edges]))
        if how == "error":
            label = F.when(known & ((x < lo) | (x > hi)), F.raise_error(F.concat(F.lit("a value outside the fitted range: "), x.cast("string")))).otherwise(label)
        return label

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = self._label(F.col(self.getOrDefault(self.inputCol)).cast("double"))
        if self.isDefined(self.nullLabel):
            label = F.coalesce(label, F.lit(self.getOrDefault(self.nullLabel)))
        return dataset.withColumn(self.getOrDefault(self.outputCol), label)

    def edge_table(self, spark: SparkSession) -> DataFrame:
        """(label, lo, hi) of each bin."""
        edges = self.getOrDefault(self.edges)
        return spark.createDataFrame([(str(k), a, b) for k, (a, b) in enumerate(zip(edges, edges[1:]))], "label string, lo double, hi double")


class EqualWidthBinner(Estimator, _BinParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns ``numBins`` equal-width bins of a numeric column's range: one aggregate; NaN and infinities do not count."""

    numBins = Param(Params._dummy(), "numBins", "number of bins", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, numBins=5, outside="end", nullLabel=None):
        super().__init__()
        self._setDefault(numBins=5, outside="end")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> EqualWidthBinnerModel:
        self._checked()
        n = self.getOrDefault(self.numBins)
        if n < 1:
            raise ValueError("numBins must be at least 1")
        lo, hi = target_range(dataset, self.getOrDefault(self.inputCol)).first()
        # The order of operations of ``equal_width_edges``; the range's own end is the last edge.
        edges = [] if lo is None else [*(lo + (hi - lo) * float(i) / float(n) for i in range(n)), hi]
        label = self.getOrDefault(self.nullLabel) if self.isDefined(self.nullLabel) else None
        return EqualWidthBinnerModel(inputCol=self.getOrDefault(self.inputCol), outputCol=self.getOrDefault(self.outputCol), edges=edges,
                                     outside=self.getOrDefault(self.outside), nullLabel=label)
