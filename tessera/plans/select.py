"""Model selection in a fixed number of Spark jobs, whatever the grid size.

Cross-validation (``cv_lambda`` / ``cv_degree``):

1. fold tags: a count and two small jobs (exact, no shuffle of rows);
2. per-fold moments (n, mean, M2) of every feature: one ``groupBy(fold)``;
   the training-fold mean/std are merged from the other folds (Chan's
   formula -- merged, not subtracted);
3. per-fold R factor of [design(x_g), y] where x_g is x normalised with the
   global moments: ONE grouped TSQR job, each row used once;
4. on the driver, for training fold k: ``z_k = a·x_g + b`` is affine, so each
   power z_k^i is a fixed combination of x_g^0..x_g^i and the design of the
   fold-normalised data is ``D_g · A_k``.  ``M = R · diag(A_k, 1)`` satisfies
   MᵀM = [D_z y]ᵀ[D_z y], so every fit and every validation SSE of every
   grid value is a small dense computation;
5. absolute losses (mae, l1) cannot be fitted from R: all (fold, grid value)
   models descend together, one job per epoch over the cached design;
6. only when metrics need rows (an inverse target transform, mae, l1, own
   metrics) one more job scores all (fold, grid value) pairs at once.

``lambda_sweep`` is the same with one split instead of folds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import dlit, display_name, poly_terms
from tessera.functions.metrics import Metric, get_metric
from tessera.operators.moments import factor_table, merge_factors, tsqr
from tessera.operators.prep import target_transform
from tessera.operators.regress import FitSpec, descend_rows, gradient_descent_grid, solve_ols, solve_ridge_grid
from tessera.operators.rank import hash_key
from tessera.operators.split import fold_column, split_column
from tessera.session import staged

NUMPY_INVERSE = {"exp": np.exp, "log": np.log}


# ------------------------------------------------------------- small helpers

def best_param(curve: DataFrame, param_col: str, score_col: str, minimize: bool, position_col: str = "position") -> DataFrame:
    """The grid row with the best score; the first position wins ties."""
    score = F.col(score_col)
    key = F.struct((score if minimize else -score).alias("s"), F.col(position_col).alias("p"))
    picked = curve.filter(score.isNotNull()).agg(
        F.min_by(F.struct(F.col(position_col).alias(position_col), F.col(param_col).alias(param_col), score.alias(score_col)), key).alias("_b")
    )
    return picked.select("_b.*")


def improvement_pct(before: Column, after: Column, minimize: bool = True) -> Column:
    """(before − after)/before·100 for errors, (after − before)/before·100 for scores."""
    return F.try_divide((before - after) if minimize else (after - before), before) * 100


def merge_moments(parts: Sequence[tuple[float, float, float]]) -> tuple[float, float, float]:
    """Merge (n, mean, M2) triples (Chan et al.)."""
    n, mean, m2 = 0.0, 0.0, 0.0
    for nb, mb, m2b in parts:
        if not nb:
            continue
        delta = mb - mean
        tot = n + nb
        mean = mean + delta * nb / tot
        m2 = m2 + m2b + delta * delta * n * nb / tot
        n = tot
    return n, mean, m2


def affine_design_map(a: np.ndarray, b: np.ndarray, degree: int) -> np.ndarray:
    """A with design(a·x + b) = design(x) · A (degree-major, intercept first)."""
    p = len(a)
    q = 1 + degree * p

    def idx(i, c):
        return 0 if i == 0 else 1 + (i - 1) * p + c

    A = np.zeros((q, q))
    A[0, 0] = 1.0
    for c in range(p):
        for i in range(1, degree + 1):
            for j in range(0, i + 1):
                A[idx(j, c), idx(i, c)] += math.comb(i, j) * a[c] ** j * b[c] ** (i - j)
    return A


def _augment(A: np.ndarray) -> np.ndarray:
    q = A.shape[0]
    out = np.zeros((q + 1, q + 1))
    out[:q, :q] = A
    out[q, q] = 1.0
    return out


def _sse(m: np.ndarray, cols: Sequence[int], beta: np.ndarray) -> float:
    e = m[:, cols] @ beta - m[:, -1]
    return float(e @ e)


def _solve_grid(m: np.ndarray, n: int, cols: list[int], spec: FitSpec, alphas: Sequence[float]) -> list[np.ndarray]:
    """Coefficients for every penalty of a grid on one design, from its R
    factor; gradient descent runs all penalties at once."""
    sub = m[:, cols + [m.shape[1] - 1]]
    if spec.method == "gradient_descent":
        B = gradient_descent_grid(sub, n, spec, alphas)
        return [B[:, j] for j in range(B.shape[1])]
    if spec.regularization == "l2":
        return solve_ridge_grid(sub, n, alphas, spec.exclude_intercept)
    return [solve_ols(sub, n)] * len(alphas)


def _checked(spec: FitSpec, alphas: Sequence[float]) -> FitSpec:
    """Every penalty weight of a grid must be valid for the fit."""
    for a in alphas:
        FitSpec(**{**spec.__dict__, "alpha": float(a)}).validated()
    return spec


def _needs_rows(spec: FitSpec) -> bool:
    return spec.method == "gradient_descent" and spec.loss in ("mae", "l1")


def _fit_rows(
    data: DataFrame,
    terms: Sequence[Column],
    y: Column,
    group: Column,
    spec: FitSpec,
    models: Sequence[tuple[int, np.ndarray, float, int]],
) -> list[np.ndarray]:
    """Absolute-loss fits of many models at once.

    A model is (group left out, map of its design from the common one, penalty
    weight, number of its coefficients); see :func:`descend_rows`.
    """
    left_out, maps, alphas, widths = zip(*models)
    mask = np.arange(len(terms))[:, None] < np.array(widths)[None, :]
    best = descend_rows(data, terms, y, spec, alphas, group, left_out, maps, mask)[0]
    return [best[:q, j] for j, (_, _, _, q) in enumerate(models)]


def _moments_by(df: DataFrame, feats: Sequence[str], group: Column) -> dict:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(feats):
        x = F.col(f).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), (F.var_pop(x) * F.count(x)).alias(f"q{i}")]
    rows = df.groupBy(group.alias("_g")).agg(*aggs).collect()
    return {r["_g"]: [(r[f"n{i}"], r[f"m{i}"] or 0.0, r[f"q{i}"] or 0.0) for i in range(len(feats))] for r in rows}


def _norm_from(parts, zero_std: float) -> tuple[np.ndarray, np.ndarray]:
    means, stds = [], []
    for triples in zip(*parts):
        n, m, m2 = merge_moments(triples)
        s = math.sqrt(m2 / (n - 1)) if n > 1 else float("nan")
        means.append(m)
        stds.append(zero_std if s == 0 else s)
    return np.array(means), np.array(stds)


def _predictions(feats: Sequence[str], params: dict, degree_of: Sequence[int]):
    """batch -> (group, y, predictions of every grid value); ``params[g] =
    (mean, std, B)`` with B a (q_max x L) coefficient matrix of the normalised
    design."""
    p, d_max = len(feats), max(degree_of)

    def of(pdf):
        for g, sub in pdf.groupby("_g", sort=False):
            if g not in params:
                continue
            mean, std, B = params[g]
            x = (sub[[f"_f{i}" for i in range(p)]].to_numpy(np.float64) - mean) / std
            cols = [np.ones(len(sub))]
            for i in range(1, d_max + 1):
                cols += [x[:, c] ** i for c in range(p)]
            yield g, sub["_y"].to_numpy(np.float64), np.column_stack(cols) @ B

    return of


def _score_rows(
    df: DataFrame,
    feats: Sequence[str],
    y: Column,
    group: Column,
    params: dict,
    degree_of: Sequence[int],
    inverse,
    metrics: Sequence[Metric],
) -> dict:
    """{(group, grid position): {metric: value}} on the rows of each group.

    The known metrics under a named inverse are sums over tasks, with the
    total sum of squares from Spark's merged moments.  Own metrics and callable
    inverses are evaluated as the Spark aggregates that they are, on one row
    per (row, grid value)."""
    of = _predictions(feats, params, degree_of)
    proj = df.select(group.cast("string").alias("_g"), *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(feats)],
                     y.cast("double").alias("_y")).dropna()
    names = [m.name for m in metrics]
    if callable(inverse) or any(m is not get_metric_or_none(m.name) for m in metrics):

        def rows(batches):
            for pdf in batches:
                for g, yt, P in of(pdf):
                    yield pd.DataFrame({"_g": g, "_y": yt, "_p": list(P)})

        long = proj.mapInPandas(rows, "_g string, _y double, _p array<double>")
        long = long.select("_g", "_y", F.posexplode("_p").alias("_l", "_q"))
        inv = target_transform(inverse) or (lambda c: c)
        scored = long.select("_g", "_l", inv(F.col("_y")).alias("_y"), inv(F.col("_q")).alias("_q"))
        out = scored.groupBy("_g", "_l").agg(*[m(F.col("_y"), F.col("_q")) for m in metrics]).collect()
        return {(r["_g"], r["_l"]): {n: r[n] for n in names} for r in out}

    forward = NUMPY_INVERSE[inverse] if inverse is not None else (lambda v: v)

    def sums(batches):
        acc = {}
        for pdf in batches:
            for g, yt, P in of(pdf):
                e = forward(P) - forward(yt)[:, None]
                acc[g] = acc.get(g, 0) + np.stack([(e * e).sum(axis=0), np.abs(e).sum(axis=0)], axis=1)
        rows = [(str(g), l, float(a[l, 0]), float(a[l, 1])) for g, a in acc.items() for l in range(len(a))]
        if rows:
            yield pd.DataFrame(rows, columns=["_g", "_l", "sse", "sae"])

    errors = proj.mapInPandas(sums, "_g string, _l int, sse double, sae double")
    errors = errors.groupBy("_g", "_l").agg(F.sum("sse").alias("sse"), F.sum("sae").alias("sae")).collect()
    scale = (target_transform(inverse) or (lambda c: c))(F.col("_y"))
    spread_ = {r["_g"]: r for r in proj.groupBy("_g").agg(F.count("*").alias("n"), (F.var_pop(scale) * F.count("*")).alias("sst")).collect()}
    return {
        (r["_g"], r["_l"]): _metric_values(names, spread_[r["_g"]]["n"], r["sse"], spread_[r["_g"]]["sst"], r["sae"]) for r in errors
    }


def get_metric_or_none(name: str) -> Metric | None:
    try:
        return get_metric(name)
    except ValueError:
        return None


def _from_factor(metrics: Sequence[Metric], inverse) -> bool:
    """Whether the metrics follow from squared residuals alone."""
    return inverse is None and all(m.name in ("mse", "r2", "l2") and m is get_metric_or_none(m.name) for m in metrics)


def _metric_values(names: Sequence[str], n: float, sse: float, sst: float, sae: float | None = None) -> dict:
    if not n:
        return {m: None for m in names}
    known = {"mse": sse / n, "r2": 1 - sse / sst if sst > 0 else None, "l2": math.sqrt(sse),
             "mae": None if sae is None else sae / n, "l1": sae}
    return {m: known[m] for m in names}


# ------------------------------------------------------------------ results

@dataclass(frozen=True)
class GridResult:
    curve: DataFrame  # (position, param, metric…)
    best: dict  # metric -> (param, value)
    folds: DataFrame | None = None  # (fold, position, param, metric…)
    weights: DataFrame | None = None  # (position, lambda, feature, weight)


def _grid_frames(
    spark: SparkSession, param_name: str, grid, metrics: Sequence[Metric], per_group: dict, groups
) -> tuple[DataFrame, DataFrame, dict]:
    """Curve (mean over groups), fold scores and the best grid value of each
    metric; a score that no group has is NULL."""
    names = [m.name for m in metrics]
    schema_m = ", ".join(f"`{m}` double" for m in names)
    none = dict.fromkeys(names)
    fold_rows, curve_rows = [], []
    for l, v in enumerate(grid):
        scores = [per_group.get((g, l), none) for g in groups]
        fold_rows += [(int(g), l, float(v), *[sc[m] for m in names]) for g, sc in zip(groups, scores)]
        means = []
        for m in names:
            found = [sc[m] for sc in scores if sc[m] is not None]
            means.append(float(np.mean(found)) if found else None)
        curve_rows.append((l, float(v), *means))
    curve = spark.createDataFrame(curve_rows, f"position int, {param_name} double, {schema_m}")
    folds = spark.createDataFrame(fold_rows, f"fold int, position int, {param_name} double, {schema_m}")
    best = {}
    for i, m in enumerate(metrics):
        cand = [(r[2 + i] if m.minimize else -r[2 + i], r[0], r) for r in curve_rows if r[2 + i] is not None]
        if cand:
            row = min(cand, key=lambda c: c[:2])[2]
            best[m.name] = (row[1], row[2 + i])
    return curve, folds, best


# -------------------------------------------------------------- CV and sweep

def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key_cols: Sequence[str],
    grid: Sequence[float],
    variable: str = "penalty",
    n_splits: int = 5,
    seed: int = 42,
    degree: int = 1,
    normalize: bool = True,
    transform_target=None,
    inverse=None,
    metrics: Sequence[str | Metric] = ("mse", "r2"),
    fit_params: Mapping | None = None,
) -> GridResult:
    """k-fold CV over a grid of penalties (``variable='penalty'``), degrees
    (``'degree'``) or nothing (``'plain'``: one fit per fold).

    ``transform_target`` and ``inverse`` are names (``'log'``, ``'exp'``) or
    functions of a Column; metrics are names or :class:`Metric` objects.
    """
    if variable not in ("penalty", "degree", "plain"):
        raise ValueError(f"unknown variable {variable!r}")
    if transform_target is not None and inverse is None:
        raise ValueError("inverse must be given when the target is transformed")
    feats = list(features)
    fit_params = dict(fit_params or {})
    spec = FitSpec(**{"method": "pseudo_inverse", "regularization": "l2" if variable == "penalty" else None, **fit_params}).validated()
    grid = list(grid) if variable != "plain" else [0.0]
    degrees = [int(v) for v in grid] if variable == "degree" else [degree] * len(grid)
    _checked(spec, grid if variable == "penalty" else [spec.alpha])
    metrics = [get_metric(m) for m in metrics]

    narrow = df.select(*key_cols, *feats, target).withColumn("_h", hash_key(seed, key_cols))
    with staged(narrow, by=key_cols) as base_df:
        return _cross_validate(base_df, feats, target, key_cols, grid, variable, n_splits, seed, normalize,
                               transform_target, inverse, metrics, spec, degrees)


def _cross_validate(df, feats, target, key_cols, grid, variable, n_splits, seed, normalize, transform_target, inverse,
                    metrics, spec, degrees) -> GridResult:
    spark = df.sparkSession
    p = len(feats)
    d_max = max(degrees)
    n = df.count()
    fold = fold_column(df, key_cols, n_splits, seed, n=n, h=F.col("_h"))
    data = df.select(*feats, target, fold.alias("_fold"))
    y = F.col(target) if transform_target is None else target_transform(transform_target)(F.col(target))

    moments = _moments_by(data, feats, F.col("_fold"))
    folds = sorted(moments)
    g_mean, g_std = _norm_from([moments[k] for k in folds], 1.0)
    g_std = np.where(np.isfinite(g_std) & (g_std > 0), g_std, 1.0)
    base = {f: (F.col(f) - dlit(g_mean[i])) / dlit(g_std[i]) for i, f in enumerate(feats)}
    terms = [c for _, c in poly_terms(feats, d_max, base)]
    factors = tsqr(data, [F.lit(1.0), *terms, y], group=F.col("_fold"))
    R = {int(g): factors[g] for g in factors}

    alphas = [float(v) for v in grid] if variable == "penalty" else [spec.alpha] * len(grid)
    widths = [1 + d * p for d in degrees]
    maps, norms = {}, {}
    for k in folds:
        train_parts = [moments[j] for j in folds if j != k]
        norms[k] = _norm_from(train_parts, 1e-8) if normalize else (np.zeros(p), np.ones(p))
        m_k, s_k = norms[k]
        maps[k] = affine_design_map(g_std / s_k, (g_mean - m_k) / s_k, d_max)
    if _needs_rows(spec):
        models = [(k, maps[k], alphas[l], widths[l]) for k in folds for l in range(len(grid))]
        fitted = _fit_rows(data, [F.lit(1.0), *terms], y, F.col("_fold"), spec, models)
        betas = {k: fitted[i * len(grid) : (i + 1) * len(grid)] for i, k in enumerate(folds)}
    from_factor = _from_factor(metrics, inverse)
    names = [m.name for m in metrics]
    per_group, fold_params = {}, {}
    for k in folds:
        A = _augment(maps[k])
        m_tr = merge_factors([R[j][0] for j in folds if j != k]) @ A
        n_tr = sum(R[j][1] for j in folds if j != k)
        m_val, n_val = R[k][0] @ A, R[k][1]
        sst = _sse(m_val, [0], solve_ols(m_val[:, [0, -1]], n_val))
        if _needs_rows(spec):
            found = betas[k]
        elif variable == "penalty":
            found = _solve_grid(m_tr, n_tr, list(range(widths[0])), spec, alphas)
        else:
            found = [_solve_grid(m_tr, n_tr, list(range(q)), spec, [spec.alpha])[0] for q in widths]
        B = np.zeros((1 + d_max * p, len(grid)))
        for l, beta in enumerate(found):
            B[: len(beta), l] = beta
            if from_factor:
                per_group[(k, l)] = _metric_values(names, n_val, _sse(m_val, list(range(len(beta))), beta), sst)
        fold_params[str(k)] = (*norms[k], B)
    if not from_factor:
        # the design of the scoring job uses the fold normalisation directly
        scores = _score_rows(data, feats, y, F.col("_fold"), fold_params, degrees, inverse, metrics)
        per_group = {(int(g), l): v for (g, l), v in scores.items()}
    name = {"penalty": "lambda", "degree": "degree", "plain": "param"}[variable]
    curve, fold_df, best = _grid_frames(spark, name, grid, metrics, per_group, folds)
    return GridResult(curve, best, fold_df)


def cv_lambda(df, features, target, key_cols, lambdas, **kwargs) -> GridResult:
    return cross_validate(df, features, target, key_cols, lambdas, "penalty", **kwargs)


def cv_degree(df, features, target, key_cols, degrees, **kwargs) -> GridResult:
    return cross_validate(df, features, target, key_cols, degrees, "degree", **kwargs)


def cv_plain(df, features, target, key_cols, **kwargs) -> GridResult:
    return cross_validate(df, features, target, key_cols, [0.0], "plain", **kwargs)


def lambda_sweep(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key_cols: Sequence[str],
    lambdas: Sequence[float],
    test_size: float = 0.2,
    seed: int = 42,
    degree: int = 1,
    normalize: bool = True,
    inverse=None,
    metrics: Sequence[str | Metric] = ("mse", "r2"),
    fit_params: Mapping | None = None,
) -> GridResult:
    """One split; for each λ fit, keep the weights (no intercept) and test metrics.

    Jobs: split (count + 2 small), train moments (1), TSQR of train and test
    (1), plus one scoring job only with an inverse transform.
    """
    feats = list(features)
    spec = FitSpec(**{"method": "pseudo_inverse", "regularization": "l2", **dict(fit_params or {})}).validated()
    _checked(spec, lambdas)
    metrics = [get_metric(m) for m in metrics]
    narrow = df.select(*key_cols, *feats, target).withColumn("_h", hash_key(seed, key_cols))
    with staged(narrow, by=key_cols) as base_df:
        return _lambda_sweep(base_df, feats, target, key_cols, lambdas, test_size, seed, degree, normalize, inverse,
                             metrics, spec)


def _lambda_sweep(df, feats, target, key_cols, lambdas, test_size, seed, degree, normalize, inverse, metrics, spec) -> GridResult:
    spark = df.sparkSession
    p = len(feats)
    is_test = split_column(df, key_cols, test_size, seed, n=df.count(), h=F.col("_h"))
    data = df.select(*feats, target, is_test.cast("int").alias("_test"))
    moments = _moments_by(data, feats, F.col("_test"))
    if normalize:
        mean, std = _norm_from([moments.get(0, [(0, 0.0, 0.0)] * p)], 1.0)
    else:
        mean, std = np.zeros(p), np.ones(p)
    base = {f: (F.col(f) - dlit(mean[i])) / dlit(std[i]) for i, f in enumerate(feats)}
    terms = poly_terms(feats, degree, base)
    factors = tsqr(data, [F.lit(1.0), *[c for _, c in terms], F.col(target)], group=F.col("_test"))
    if "0" not in factors:
        raise ValueError("the training side of the split is empty")
    r_tr, n_tr = factors["0"]
    # without test rows (a small table or test_size) every score is NULL
    r_te, n_te = factors.get("1", (np.zeros_like(r_tr), 0))
    width = 1 + degree * p
    alphas = [float(v) for v in lambdas]
    design = [F.lit(1.0), *[c for _, c in terms]]
    if _needs_rows(spec):
        models = [(1, np.eye(width), a, width) for a in alphas]
        betas = _fit_rows(data, design, F.col(target), F.col("_test"), spec, models)
    else:
        betas = _solve_grid(r_tr, n_tr, list(range(width)), spec, alphas)
    names = [m.name for m in metrics]
    per_group, weight_rows = {}, []
    for l, beta in enumerate(betas):
        weight_rows += [(l, alphas[l], nm, float(b)) for (nm, _), b in zip(terms, beta[1:])]
        if n_te and _from_factor(metrics, inverse):
            sst = _sse(r_te, [0], solve_ols(r_te[:, [0, -1]], n_te))
            per_group[(1, l)] = _metric_values(names, n_te, _sse(r_te, list(range(width)), beta), sst)
    if n_te and not _from_factor(metrics, inverse):
        B = np.column_stack(betas)
        scores = _score_rows(data, feats, F.col(target), F.col("_test"), {"1": (mean, std, B)}, [degree] * len(lambdas), inverse, metrics)
        per_group = {(1, l): v for (_, l), v in scores.items()}
    curve, _, best = _grid_frames(spark, "lambda", lambdas, metrics, per_group, [1])
    weights = spark.createDataFrame(weight_rows, "position int, lambda double, feature string, weight double")
    return GridResult(curve, best, None, weights)


# ------------------------------------------------------------ segment models

def segment_fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    segment_col: str,
    total_label: str | None = "all",
    degree: int = 1,
) -> DataFrame:
    """One least-squares model per segment plus one over all rows.

    Every segment is solved where its factors meet, so segments are not
    counted, collected or bounded; the total merges a copy of all factors.
    Returns (segment, is_total, term, coefficient, n); the NULL segment has
    its own model, and ``is_total`` tells the total from a segment of its name.
    """
    names, terms = zip(*poly_terms(list(features), degree))
    design = [F.lit(1.0), *terms, F.col(target)]
    k = len(design)
    parts = factor_table(df, design, F.col(segment_col)).withColumn("_total", F.lit(False))
    if total_label is not None:
        whole = factor_table(df, design).select(F.lit(total_label).alias("_g"), "_n", "_r", F.lit(True).alias("_total"))
        parts = parts.unionByName(whole)
    labels = ["intercept", *names]

    def solve(batches):
        for pdf in batches:
            rows = []
            for g, n, r, t in zip(pdf["_g"], pdf["_n"], pdf["_r"], pdf["_total"]):
                beta = solve_ols(np.asarray(r, np.float64).reshape(k, k), int(n))
                rows += [(g, bool(t), nm, float(b), int(n)) for nm, b in zip(labels, beta)]
            if rows:
                yield pd.DataFrame(rows, columns=["segment", "is_total", "term", "coefficient", "n"])

    return parts.mapInPandas(solve, "segment string, is_total boolean, term string, coefficient double, n long")


def feature_impact(
    coefs: DataFrame,
    df: DataFrame,
    segment_col: str,
    target: str,
    feature: str,
    total_label: str = "all",
) -> DataFrame:
    """Per segment model: coefficient of ``feature``, average target, their
    ratio in percent, and a display name.  Segments without the feature are
    skipped; the NULL segment counts like any other.  Segments of the models
    that the data do not have, or the other way round, raise."""
    avg = (
        df.rollup(segment_col)
        .agg(F.avg(target).alias("average_target"), F.grouping(segment_col).alias("_tot"))
        .select(
            (F.col("_tot") == 1).alias("_all"),
            F.when(F.col("_tot") == 1, F.lit(total_label)).otherwise(F.col(segment_col).cast("string")).alias("_seg"),
            "average_target",
        )
    )
    fitted = coefs.select("segment", "is_total").distinct()
    same = F.col("segment").eqNullSafe(F.col("_seg")) & (F.col("is_total") == F.col("_all"))
    known = avg.filter(~F.col("_all") & F.col("average_target").isNotNull())
    unmatched = fitted.join(avg, same, "left_anti").count() + known.join(fitted, same, "left_anti").count()
    if unmatched:
        raise ValueError(f"{unmatched} segments are on one side only (models or data)")
    c = coefs.filter(F.col("term") == feature).select("segment", "is_total", F.col("coefficient").alias("absolute_impact"))
    return c.join(avg, same).select(
        "segment",
        F.lit(feature).alias("feature_name"),
        display_name(F.lit(feature)).alias("display_name"),
        "absolute_impact",
        "average_target",
        (F.try_divide(F.col("absolute_impact"), F.col("average_target")) * 100).alias("percentage_impact"),
    )


def fold_norm_params(
    df: DataFrame, features: Sequence[str], key_cols: Sequence[str], n_splits: int = 5, seed: int = 42, zero_std: float = 1e-8
) -> DataFrame:
    """Normalisation parameters of every training fold (all folds but k):
    (fold, feature, mean, std), merged from one per-fold moments job."""
    feats = list(features)
    fold = fold_column(df, key_cols, n_splits, seed)
    moments = _moments_by(df.select(*feats, fold.alias("_fold")), feats, F.col("_fold"))
    rows = []
    for k in sorted(moments):
        m, s = _norm_from([moments[j] for j in moments if j != k], zero_std)
        for i, f in enumerate(feats):
            rows.append((int(k), f, float(m[i]), float(s[i])))
    return df.sparkSession.createDataFrame(rows, "fold int, feature string, mean double, std double")
