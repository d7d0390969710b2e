"""Cox proportional hazards by Newton steps whose sums are Spark aggregates.

Times are whole days, so sums per distinct time form a table of at most one row per day; only the
gradient, the p x p Hessian and the baseline (one row per day) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from faultline import config
from faultline.functions import scalars as S
from faultline.session import checkpoint


@dataclass
class CoxModel:
    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray  # on standardised features
    baseline_days: np.ndarray
    baseline_hazard: np.ndarray  # cumulative, at the feature means
    log_likelihood: float
    gradient: np.ndarray
    iterations: int
    converged: bool  # the gradient met the tolerance
    n_rows: int

    def log_risk(self) -> Column:
        parts = [(F.col(f"`{c}`").cast("double") - float(m)) * float(b / s)
                 for c, m, s, b in zip(self.features, self.mean, self.scale, self.beta)]
        return sum(parts, F.lit(0.0))

    def coefficients(self, spark) -> DataFrame:
        """Coefficient per unit of the feature and its hazard ratio, and whether the fit converged in how many steps."""
        rows = [(c, float(b / s), float(np.exp(b / s)), self.converged, self.iterations)
                for c, b, s in zip(self.features, self.beta, self.scale)]
        return spark.createDataFrame(rows, "feature string, coefficient double, hazard_ratio double, converged boolean, iterations int")

    def largest_slope(self) -> float:
        """The largest entry of the penalised gradient per row."""
        return float(np.max(np.abs(self.gradient))) / max(self.n_rows, 1)

    def monotone(self) -> bool:
        """Whether the cumulative baseline hazard never falls."""
        return bool(np.all(np.diff(self.baseline_hazard) >= 0))

    def hazard_at(self, days: int) -> float:
        """Cumulative baseline hazard at the time point nearest to the horizon."""
        return float(self.baseline_hazard[int(np.argmin(np.abs(self.baseline_days - days)))])


# Sums over the d tied events of one day, l = 0 .. d-1, of f, f squared and -log f, with
# f = 1 / (s - l/d * e). A handful of ties is summed; beyond, the sums are differences of polygamma values
# (shifted asymptotic series), so the cost of a day does not grow with its number of events.
_DIRECT_TIES = 8
_SHIFT = range(12)


def _digamma(x: str) -> str:
    back = " + ".join(f"1D / ({x} + {k})" for k in _SHIFT)
    y = f"({x} + {len(_SHIFT)})"
    i = f"(1D / ({y} * {y}))"
    return f"(ln({y}) - 0.5D / {y} - {i} * (1D/12 - {i} * (1D/120 - {i} * (1D/252 - {i} / 240))) - ({back}))"


def _trigamma(x: str) -> str:
    back = " + ".join(f"1D / (({x} + {k}) * ({x} + {k}))" for k in _SHIFT)
    y = f"({x} + {len(_SHIFT)})"
    i = f"(1D / ({y} * {y}))"
    return f"(1D / {y} + {i} / 2 + {i} / {y} * (1D/6 - {i} * (1D/30 - {i} * (1D/42 - {i} / 30))) + ({back}))"


def _log_gamma(x: str) -> str:
    back = " + ".join(f"ln({x} + {k})" for k in _SHIFT)
    y = f"({x} + {len(_SHIFT)})"
    i = f"(1D / ({y} * {y}))"
    series = f"(1D/12 - {i} * (1D/360 - {i} / 1260)) / {y}"
    return f"(({y} - 0.5D) * ln({y}) - {y} + 0.9189385332046727D + {series} - ({back}))"


def _with_tie_sums(daily: DataFrame) -> DataFrame:
    """Add f1, f2 and logs to rows of (s, e_s, d)."""
    few = f"sequence(0, CAST(least(d, {_DIRECT_TIES}) AS INT) - 1)"

    def total(term: str) -> str:
        v = "(s - k / d * e_s)"
        return f"aggregate({few}, 0D, (acc, k) -> acc + {term.format(v=v)})"

    many = f"d > {_DIRECT_TIES}"
    return daily.selectExpr("*", "e_s / d AS _step", "s / (e_s / d) + 1 AS _top", "s / (e_s / d) - d + 1 AS _low").selectExpr(
        "*",
        f"CASE WHEN {many} THEN ({_digamma('_top')} - {_digamma('_low')}) / _step ELSE {total('1D / {v}')} END AS f1",
        f"CASE WHEN {many} THEN ({_trigamma('_low')} - {_trigamma('_top')}) / (_step * _step)"
        f" ELSE {total('1D / ({v} * {v})')} END AS f2",
        f"CASE WHEN {many} THEN d * ln(_step) + {_log_gamma('_top')} - {_log_gamma('_low')} ELSE {total('ln({v})')} END AS logs",
    )


def _step(rows: DataFrame, p: int, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, gradient and observed information at ``beta`` (ties by Efron's rule)."""
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    eta = " + ".join(f"_x{i} * {float(beta[i])!r}D" for i in range(p))
    scored = rows.selectExpr("*", f"{eta} AS _eta", f"exp({eta}) AS _r")
    terms = {"s": "_r"} | {f"a{i}": f"_r * _x{i}" for i in range(p)} | {f"m{i}_{j}": f"_r * _x{i} * _x{j}" for i, j in upper}
    sums = [f"sum({t}) AS {k}" for k, t in terms.items()]
    sums += [f"coalesce(sum({t}) FILTER (WHERE _e = 1), 0D) AS e_{k}" for k, t in terms.items()]
    sums += [f"coalesce(sum(_x{i}) FILTER (WHERE _e = 1), 0D) AS x{i}" for i in range(p)]
    sums += ["count_if(_e = 1) AS d", "coalesce(sum(_eta) FILTER (WHERE _e = 1), 0D) AS eta"]
    daily = scored.groupBy("_t").agg(*[F.expr(x) for x in sums])
    # At most one row per day: the running sums over later days fit one task.
    over = "OVER (PARTITION BY 0 ORDER BY _t DESC ROWS UNBOUNDED PRECEDING)"
    own = ["d", "eta", *[f"x{i}" for i in range(p)], *[f"e_{k}" for k in terms]]
    risk_sets = daily.selectExpr(*own, *[f"sum({k}) {over} AS {k}" for k in terms]).filter("d > 0")
    # g1 = sum l/d f, h1 = sum l/d f^2, h2 = sum (l/d f)^2, all from f1 and f2.
    t = _with_tie_sums(risk_sets).selectExpr(
        "*", "(s * f1 - d) / e_s AS g1", "(s * f2 - f1) / e_s AS h1", "(s * s * f2 - s * f1 * 2 + d) / (e_s * e_s) AS h2")
    out = ["sum(eta - logs) AS ll"]
    out += [f"sum(x{i} - f1 * a{i} + g1 * e_a{i}) AS g{i}" for i in range(p)]
    out += [f"sum(f1 * m{i}_{j} - g1 * e_m{i}_{j} - (f2 * a{i} * a{j} - h1 * (a{i} * e_a{j} + e_a{i} * a{j})"
            f" + h2 * e_a{i} * e_a{j})) AS i{i}_{j}" for i, j in upper]
    one = t.agg(*[F.expr(x) for x in out]).first()  # one row of sums
    grad = np.array([one[f"g{i}"] for i in range(p)])
    info = np.zeros((p, p))
    for i, j in upper:
        info[i, j] = info[j, i] = one[f"i{i}_{j}"]
    return float(one["ll"]), grad, info


#: Times longer than this many days (300 years) are taken for another unit.
LONGEST_DAYS = 109_575


def fit_cox(records: DataFrame, time: str, event: str, features: Sequence[str], penalty: float = 0.1,
            max_steps: int = 100, tolerance: float = 1e-7) -> CoxModel:
    """Newton's method on the penalised partial likelihood of standardised features.

    ``time`` holds whole days, as sums are kept per day: other types and times of over ``LONGEST_DAYS`` are refused. The model says
    whether it converged.
    """
    if not isinstance(records.schema[time].dataType, T.IntegralType):
        raise ValueError(f"{time} must hold whole days")
    features = list(features)
    p = len(features)
    stats = records.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col(time).cast("bigint"))).alias("longest"), *[
        g(F.col(f"`{c}`").cast("double")).alias(f"{k}{i}")
        for i, c in enumerate(features) for k, g in (("m", F.avg), ("s", F.stddev_samp))]).first()
    if (stats["longest"] or 0) > LONGEST_DAYS:
        raise ValueError(f"{time} reaches {stats['longest']}: it must hold days")
    mean = np.array([stats[f"m{i}"] for i in range(p)], dtype=float)
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(p)], dtype=float)
    n = stats["n"]
    rows = checkpoint(records.select(
        F.col(time).alias("_t"), F.col(event).alias("_e"),
        *[((F.col(f"`{c}`").cast("double") - float(mean[i])) / float(scale[i])).alias(f"_x{i}")
          for i, c in enumerate(features)]))
    beta = np.zeros(p)

    def objective(b):
        ll, grad, info = _step(rows, p, b)
        return ll - 0.5 * n * penalty * float(b @ b), grad - n * penalty * b, info + n * penalty * np.eye(p)

    value, grad, info = objective(beta)
    steps = 0
    while steps < max_steps and np.max(np.abs(grad)) / n > tolerance:
        direction = np.linalg.solve(info, grad)
        size = 1.0
        while True:  # halve until the likelihood improves
            trial = objective(beta + size * direction)
            better = trial[0] >= value - 1e-12 * abs(value)
            if better or size < 1e-10:
                break
            size /= 2
        if not better:
            break
        beta = beta + size * direction
        value, grad, info = trial
        steps += 1

    score = sum((F.col(f"_x{i}") * float(beta[i]) for i in range(p)), F.lit(0.0))
    daily = rows.groupBy("_t").agg(F.sum(F.exp(score)).alias("s"), F.count_if(F.col("_e") == 1).alias("d"))
    later = Window.partitionBy(F.lit(0)).orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    base = daily.withColumn("s", F.sum("s").over(later)).orderBy("_t").toPandas()  # one row per day
    hazard = np.cumsum(base["d"].to_numpy(float) / base["s"].to_numpy(float))
    return CoxModel(features, mean, scale, beta, base["_t"].to_numpy(float), hazard, value, grad, steps,
                    bool(np.max(np.abs(grad)) / n <= tolerance), n)


def survival_pof(model: CoxModel | None, assets: DataFrame, entity: str,
                 horizons: Mapping[str, int] = config.HORIZON_DAYS,
                 thresholds: Mapping[str, float] = config.RISK_THRESHOLDS) -> DataFrame:
    """Failure probability, threshold class per horizon and risk category of every asset.

    Without a model, or with missing features, the probability is one half and the class 0.
    """
    out = assets
    columns = []
    for h, days in horizons.items():
        if model is None:
            p = F.lit(0.5)
            known = F.lit(False)
        else:
            raw = F.lit(1.0) - F.exp(-F.lit(model.hazard_at(days)) * F.exp(model.log_risk()))
            known = raw.isNotNull()
            p = F.when(known, F.greatest(F.least(raw, F.lit(1.0)), F.lit(0.0))).otherwise(F.lit(0.5))
        out = out.withColumns({f"pof_{h}": p, f"risk_class_{h}": S.flag(known & (p >= thresholds[h]))})
        columns += [f"pof_{h}", f"risk_class_{h}"]
    longest = list(horizons)[-1]
    return out.select(entity, *columns, S.threshold_class(f"pof_{longest}").alias("risk_category"))
