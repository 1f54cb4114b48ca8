"""End-to-end pipelines: load -> transform target -> split -> normalise -> fit
-> predict -> metrics, and scoring of new (labelled or unlabelled) rows with
the frozen parameters.

Job count of ``train_and_evaluate``: a count and two small jobs for the exact
split, one moments aggregate for normalisation, one TSQR job for the fit, one
aggregate for the metrics -- independent of the number of rows and features.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import MSE, R2, Metric
from tessera.operators.evaluate import evaluate
from tessera.operators.prep import NormParams, fit_zscore, numeric_columns, target_transform
from tessera.operators.regress import LinearModel, fit
from tessera.operators.rank import hash_key
from tessera.operators.split import split_column
from tessera.sources.io import open_frame
from tessera.session import staged


@dataclass(frozen=True)
class FittedPipeline:
    features: tuple[str, ...]
    target: str
    model: LinearModel
    norm: NormParams | None = None
    forward: str | Callable[[Column], Column] | None = None
    inverse: str | Callable[[Column], Column] | None = None

    def base(self) -> dict[str, Column]:
        if self.norm is None:
            return {}
        return {f: self.norm.columns(f) for f in self.features if f in self.norm.mean}

    def prediction(self) -> Column:
        """ŷ on the model's (transformed) target scale."""
        return self.model.prediction(self.base())

    def transform(self, df: DataFrame, out: str = "prediction", original_scale: bool = False) -> DataFrame:
        """Stateless scoring (batch or streaming): normalisation and model as literals."""
        p = self.prediction()
        if original_scale and self.inverse is not None:
            p = target_transform(self.inverse)(p)
        return df.withColumn(out, p)

    def evaluate(self, df: DataFrame, metrics: Sequence[str | Metric] = (MSE, R2)) -> DataFrame:
        """Metrics on labelled rows; the target is transformed like in training,
        and ``inverse`` (if any) is applied to both y and ŷ."""
        y = F.col(self.target)
        if self.forward is not None:
            y = target_transform(self.forward)(y)
        inv = target_transform(self.inverse)
        return evaluate(df.select(y.alias("_y"), self.prediction().alias("_p")), "_y", "_p", metrics, inv)


@dataclass(frozen=True)
class TrainResult:
    pipeline: FittedPipeline
    metrics: DataFrame
    data: DataFrame  # input rows with the split tag and the prediction
    split_col: str


def train_and_evaluate(
    df: DataFrame | str,
    target: str,
    key_cols: Sequence[str],
    features: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    normalize: bool = True,
    transform_target: str | Callable[[Column], Column] | None = None,
    inverse: str | Callable[[Column], Column] | None = None,
    degree: int = 1,
    metrics: Sequence[str | Metric] = (MSE, R2),
    fit_params: Mapping | None = None,
    split_col: str = "is_test",
) -> TrainResult:
    """Split, normalise, fit and score; ``df`` may be a path, as in ``load_xy``."""
    if transform_target is not None and inverse is None:
        raise ValueError("inverse must be given when the target is transformed")
    df = open_frame(df)
    if fit_params is None:
        fit_params = {"method": "gradient_descent", "learning_rate": 0.01, "epochs": 1000}
    if features is None:  # every numeric column but the target and the key
        feats = [c for c in numeric_columns(df) if c != target and c not in key_cols]
    else:
        feats = list(features)
    # the narrow projection is read by 5 jobs (count, 2 split cut points,
    # moments, fit, metrics): a small one is spread over the cores and kept
    narrow = df.select(*key_cols, *feats, target).withColumn("_h", hash_key(seed, key_cols))
    with staged(narrow, by=key_cols) as data:
        split = split_column(data, key_cols, test_size, seed, n=data.count(), h=F.col("_h"))
        tagged = data.withColumn(split_col, split)
        train = tagged.filter(~F.col(split_col))
        test = tagged.filter(F.col(split_col))
        norm = fit_zscore(train, feats, "skip_binary") if normalize else None
        y = F.col(target)
        if transform_target is not None:
            y = target_transform(transform_target)(y)
        base = {f: norm.columns(f) for f in feats} if norm else None
        model = fit(train, feats, y, degree, base=base, **dict(fit_params))
        pipe = FittedPipeline(tuple(feats), target, model, norm, transform_target, inverse)
        scores = pipe.evaluate(test, metrics)
        scores = df.sparkSession.createDataFrame(scores.collect(), scores.schema)
    tagged_all = df.withColumn("_h", hash_key(seed, key_cols))
    return TrainResult(pipe, scores, pipe.transform(tagged_all.withColumn(split_col, split)).drop("_h"), split_col)


def evaluate_new_data(df: DataFrame | str, pipeline: FittedPipeline, metrics: Sequence[str | Metric] = (MSE, R2)) -> DataFrame:
    """Score a separate labelled set (a frame or a path) with the stored params and transforms."""
    return pipeline.evaluate(open_frame(df), metrics)


def predict_new_rows(df: DataFrame, pipeline: FittedPipeline, out: str = "prediction") -> DataFrame:
    """Score unlabelled rows on the original target scale (also on readStream)."""
    return pipeline.transform(df, out, original_scale=True)
