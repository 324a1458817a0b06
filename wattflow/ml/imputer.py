"""Median imputation with exact medians, as pipeline stages that save and load (M2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    def _names(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class ExactMedianImputer(Estimator, _Columns):
    """Learns the exact median of each input column; NULL and NaN are gaps.

    All columns are selected together (``operators.quantiles``), so ``dataset`` is read
    two or three times, whatever their number. A column without any value gets 0.0, as
    fully missing columns do elsewhere (P12).
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ExactMedianModel:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in self.getInputCols()])).alias("c")
        medians = exact_quantiles(dataset.select(cells).select("c.*"), "v", (0.5,), ["column"])
        known = {r["column"]: float(r["value"]) for r in medians.collect()}  # one row a column
        model = ExactMedianModel()
        return model._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols(), medians=[known.get(c, 0.0) for c in self.getInputCols()])


class ExactMedianModel(Model, _Columns):
    """Fills the gaps of each input column with its median."""

    medians = Param(Params._dummy(), "medians", "median of each input column", typeConverter=TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def surrogates(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.medians), strict=True))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = self.surrogates()
        value = {c: F.col(c).cast("double") for c in known}
        return dataset.withColumns({out: F.when(F.isnan(value[c]) | value[c].isNull(), F.lit(known[c])).otherwise(value[c]) for c, out in self._names()})
