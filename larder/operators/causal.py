"""Causal estimators as Spark jobs.

* lagged_signal_join: retail price rows joined to the USDA value `lag` weeks
  earlier whose commodity contains the item category.  The LIKE runs over the
  distinct names only; the rows join by equality on (category, date).
* elasticity: OLS of ln(retail) on ln(wholesale) from regr_* aggregates.
* did: two-way fixed effects DiD with HC1 errors.  All regressors are constant
  within a (store, date) cell, so one shuffle builds the cells; stores are
  absorbed by weighted demeaning; per-partition partial Gram matrices
  (<= 58 x 58) are built with numpy inside tasks and summed on Spark; only the
  summed matrix reaches the driver.
* rdd: interacted local-linear RDD with HC3 errors in closed form over the
  (running value, outcome) groups inside the bandwidth.
"""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from larder.functions import scalars, stats
from larder.operators import serving
from larder.session import store

# ---------------------------------------------------------------------------
# Lagged signal join
# ---------------------------------------------------------------------------


def category_commodities(categories: DataFrame, commodities: DataFrame) -> DataFrame:
    """(category, commodity) pairs where the commodity contains the category, `%` and `_` as in LIKE.

    Both inputs are distinct names (a catalogue, not data), so the LIKE runs over
    names only and the planner picks the side to broadcast.
    """
    cats = categories.filter("category IS NOT NULL").select("category").distinct()
    names = commodities.filter("commodity IS NOT NULL").select("commodity").distinct()
    pattern = r"concat('%', replace(lower(category), '\\', '\\\\'), '%')"
    return cats.join(names, F.expr(f"lower(commodity) LIKE {pattern}"))


def lagged_signal_join(history: DataFrame, ext: DataFrame, category: str | None = None,
                       lag_weeks: int = 2) -> DataFrame:
    """Price rows x USDA values `lag_weeks` earlier whose commodity contains the category.

    The LIKE between the two sides is decided once per pair of names; the rows
    then join by equality, signals on commodity and prices on (category, date).
    """
    ph = history.filter(F.col("regular_price").isNotNull())
    if category:
        ph = serving.filter_category(ph, category)
    usda = ext.filter((F.col("signal_type") == "USDA") & F.col("value").isNotNull()).select(
        F.col("signal_date"), F.col("commodity"), F.col("value").alias("usda_price"))
    named = usda.join(category_commodities(ph, usda), "commodity")
    keyed = ph.select("price_date", "item_id", "store_id", "regular_price", "category",
                      F.date_sub("price_date", 7 * lag_weeks).alias("signal_date"))
    return keyed.join(named, ["category", "signal_date"]).select(
        "price_date", "item_id", "store_id", "regular_price", "category", "usda_price", "commodity")


# ---------------------------------------------------------------------------
# Pass-through elasticity (OLS on logs), M13: Wald IV
# ---------------------------------------------------------------------------


def log_pairs(lagged: DataFrame) -> DataFrame:
    return lagged.select(
        scalars.ln_or_null(F.col("regular_price")).alias("log_retail"),
        scalars.ln_or_null(F.col("usda_price")).alias("log_usda"),
    ).dropna(subset=["log_retail", "log_usda"])


def ols_summary(df: DataFrame, y: str, x: str, min_obs: int = 50) -> DataFrame:
    """One row (n, slope, intercept, se, t) from regr_* aggregates; empty if n < min_obs."""
    agg = df.agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"),
    )
    se = F.sqrt((F.col("syy") - F.col("b") * F.col("sxy")) / (F.col("n") - 2) / F.col("sxx"))
    return agg.filter(F.col("n") >= min_obs).withColumn("se", se).withColumn("t", F.col("b") / F.col("se"))


def elasticity(lagged: DataFrame, category: str | None, lag_weeks: int, min_obs: int = 50) -> DataFrame:
    """M12 (comparable part): n, elasticity (round 4), se (round 8), t (round 4)."""
    s = ols_summary(log_pairs(lagged), "log_retail", "log_usda", min_obs)
    return s.select(
        F.lit(category).cast("string").alias("category"),
        F.lit(lag_weeks).alias("lag_weeks"),
        F.col("n").alias("n_obs"),
        (F.round("b", 4) + 0.0).alias("elasticity"),  # + 0.0 turns -0.0 into 0.0
        (F.round("se", 8) + 0.0).alias("se"),
        (F.round("t", 4) + 0.0).alias("t_stat"),
    )


def elasticity_report(lagged: DataFrame, category: str | None, lag_weeks: int, min_obs: int = 50) -> DataFrame:
    """M12 as reported: adds the classic OLS p-value (Student t, n-2 df) and the sentence."""
    s = ols_summary(log_pairs(lagged), "log_retail", "log_usda", min_obs)
    p = stats.student_p_udf(F.col("t"), (F.col("n") - 2).cast("double"))
    pct = F.format_number(F.abs(F.col("b")) * 10, 1)
    return s.select(
        F.lit(category).cast("string").alias("category"),
        F.lit(lag_weeks).alias("lag_weeks"),
        F.round("b", 4).alias("elasticity"),
        F.round(p, 6).alias("pvalue"),
        F.col("n").alias("n_obs"),
        F.concat(
            F.lit("retail price moves by "), pct,
            F.lit(f"% for each 10% at wholesale, {lag_weeks} weeks later (category: {category})"),
        ).alias("interpretation"),
    )


def with_lagged_instrument(lagged: DataFrame, ext: DataFrame, lag_weeks: int) -> DataFrame:
    """Add ln(mean wholesale value one week before the regressor's week) per commodity as instrument.

    The instrument table is aggregated to (commodity, week) before the join, so
    the join is one-to-one on (commodity, date) and cannot fan out.
    """
    inst = ext.filter((F.col("signal_type") == "USDA") & F.col("value").isNotNull()).groupBy(
        "commodity", "signal_date").agg(
        (F.sum("value").cast("double") / F.count("value").cast("double")).alias("prev_value"))
    joined = lagged.join(
        inst.withColumnRenamed("commodity", "_c"),
        (F.col("_c") == F.col("commodity"))
        & (F.col("signal_date") == F.date_sub(F.col("price_date"), 7 * (lag_weeks + 1))),
    )
    return joined.select(
        scalars.ln_or_null(F.col("regular_price")).alias("log_retail"),
        scalars.ln_or_null(F.col("usda_price")).alias("log_usda"),
        scalars.ln_or_null(F.col("prev_value")).alias("log_instrument"),
        (F.datediff("price_date", F.lit("1970-01-01").cast("date")) / F.lit(365.25)).alias("trend"),
    )


def iv_wald(df: DataFrame, y: str, x: str, z: str) -> DataFrame:
    """Just-identified IV (Wald) beta = cov(z, y) / cov(z, x); first-stage F = t^2 of x on z."""
    agg = df.dropna(subset=[y, x, z]).agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_samp(z, y).alias("czy"), F.covar_samp(z, x).alias("czx"),
        F.regr_slope(x, z).alias("b1"), F.regr_sxx(x, z).alias("szz"), F.regr_sxy(x, z).alias("szx"),
        F.regr_syy(x, z).alias("sxx"),
    )
    se1 = F.sqrt((F.col("sxx") - F.col("b1") * F.col("szx")) / (F.col("n") - 2) / F.col("szz"))
    return agg.select(
        "n",
        (F.col("czy") / F.nullif(F.col("czx"), F.lit(0.0))).alias("iv_beta"),
        F.pow(F.col("b1") / se1, 2).alias("first_stage_f"),
    )


def two_stage_least_squares(df: DataFrame, y: str, endogenous: list[str], instruments: list[str],
                            controls: tuple[str, ...] = ()) -> DataFrame:
    """2SLS with an intercept and `controls`, heteroskedasticity-robust errors: (term, coefficient, se, z, pvalue, n).

    Two passes of partial sums over the rows, of the size of the terms squared: all cross products, and, with the
    coefficients known, the products of fitted regressors weighted by squared residuals.  Only the sums reach the driver.
    Too few instruments, or ones that leave the regressors unidentified, are an error.  Rows with a null take no part.
    """
    if len(instruments) < len(endogenous):
        raise ValueError("there must be as many instruments as endogenous regressors")
    names = ["const", *controls, *endogenous]
    rows = store(df.select(F.lit(1.0).alias("const"), *[F.col(c).cast("double").alias(c) for c in (
        *controls, *endogenous, *instruments, y)]).dropna(), "iv-rows")
    x_cols, z_cols = names, ["const", *controls, *instruments]
    every = [*names, *instruments, y]
    pairs = [(a, b) for i, a in enumerate(every) for b in every[i:]]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs]).first()
    n = int(sums["n"])
    schema = "term string, coefficient double, se double, z double, pvalue double, n long"
    if n <= len(x_cols):
        return df.sparkSession.createDataFrame([], schema)
    of = {**{(a, b): sums[f"{a}|{b}"] for a, b in pairs}, **{(b, a): sums[f"{a}|{b}"] for a, b in pairs}}
    block = lambda a, b: np.array([[of[i, j] for j in b] for i in a])
    zz, zx, zy = block(z_cols, z_cols), block(z_cols, x_cols), block(z_cols, [y])
    first = np.linalg.lstsq(zz, zx, rcond=None)[0]  # fitted regressors = z @ first
    bread = first.T @ zx
    if np.linalg.matrix_rank(bread) < len(x_cols):
        raise ValueError("the instruments do not identify the regressors")
    inverse = np.linalg.inv(bread)
    beta = (inverse @ first.T @ zy)[:, 0]
    fitted = [sum((F.col(z) * float(first[i, j]) for i, z in enumerate(z_cols)), F.lit(0.0)) for j in range(len(x_cols))]
    residual = F.col(y) - sum((F.col(c) * float(v) for c, v in zip(x_cols, beta, strict=True)), F.lit(0.0))
    squared = rows.select(*[f.alias(f"f{j}") for j, f in enumerate(fitted)], (residual * residual).alias("e2"))
    places = [(i, j) for i in range(len(x_cols)) for j in range(i, len(x_cols))]
    found = squared.agg(*[F.sum(F.col("e2") * F.col(f"f{i}") * F.col(f"f{j}")).alias(f"m{i}_{j}") for i, j in places]).first()
    meat = np.zeros((len(x_cols), len(x_cols)))
    for i, j in places:
        meat[i, j] = meat[j, i] = found[f"m{i}_{j}"]
    se = np.sqrt(np.maximum(np.diag(inverse @ meat @ inverse.T), 0.0))
    out = []
    for name, b, s in zip(names, beta, se, strict=True):
        z = float(b / s) if s > 0 else None
        out.append((name, float(b), float(s), z, None if z is None else float(stats.normal_two_sided_p(z)), n))
    return df.sparkSession.createDataFrame(out, schema)


# ---------------------------------------------------------------------------
# Difference in differences
# ---------------------------------------------------------------------------


def did_panel(history: DataFrame, event_date: str, treated_states: list[str], item_category: str | None = None,
              window_weeks: int = 4) -> DataFrame:
    df = serving.event_window(history, event_date, window_weeks)
    if item_category:
        df = serving.filter_category(df, item_category)
    df = df.filter(F.col("regular_price").isNotNull())
    df = serving.flag_treated(df, treated_states)
    return df.withColumns({
        "post": (F.col("price_date") >= F.lit(dt.date.fromisoformat(event_date))).cast("int"),
    }).withColumn("treatment_x_post", F.col("treatment") * F.col("post"))


def did_cells(panel: DataFrame) -> DataFrame:
    """(store, date) cells: n, sum y, sum y^2, treatment x post (constant within the cell)."""
    y = F.col("regular_price")
    return panel.groupBy("store_id", "price_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("sum_y"),
        F.sum(y * y).alias("sum_y2"),
        F.max("treatment_x_post").alias("d"),
        F.max("treatment").alias("treatment"),
    )


def did_means(panel: DataFrame) -> DataFrame:
    """2x2 cell means and their difference in differences."""
    def mean(t: int, p: int) -> Column:
        cond = (F.col("treatment") == t) & (F.col("post") == p)
        return (F.sum(F.when(cond, F.col("regular_price"))).cast("double")
                / F.count(F.when(cond, F.lit(1))).cast("double"))

    m = panel.agg(mean(1, 1).alias("mean_treated_post"), mean(1, 0).alias("mean_treated_pre"),
                  mean(0, 1).alias("mean_control_post"), mean(0, 0).alias("mean_control_pre"))
    return m.withColumn("did_estimate", (F.col("mean_treated_post") - F.col("mean_treated_pre"))
                        - (F.col("mean_control_post") - F.col("mean_control_pre")))


_PARTIAL = StructType([StructField("i", LongType()), StructField("j", LongType()), StructField("v", DoubleType())])


def _design(group: pd.DataFrame, k: int):
    """Demeaned cell regressors Z~ (cells x k), weights n, sums, store mean of y."""
    n = group["n"].to_numpy(dtype="float64")
    sy = group["sum_y"].to_numpy(dtype="float64")
    syy = group["sum_y2"].to_numpy(dtype="float64")
    z = np.zeros((len(group), k))
    z[:, 0] = group["d"].to_numpy(dtype="float64")
    z[np.arange(len(group)), 1 + group["tau"].to_numpy(dtype="int64")] = 1.0
    ns = n.sum()
    zt = z - (n @ z) / ns
    return zt, n, sy, syy, sy.sum() / ns


def _emit(mat: np.ndarray, vec: np.ndarray, scalars_: list[float]) -> pd.DataFrame:
    k = mat.shape[0]
    ii, jj = np.triu_indices(k)
    parts = [
        pd.DataFrame({"i": ii, "j": jj, "v": mat[ii, jj]}),
        pd.DataFrame({"i": np.full(k, -1), "j": np.arange(k), "v": vec}),
        pd.DataFrame({"i": np.full(len(scalars_), -2), "j": np.arange(len(scalars_)), "v": scalars_}),
    ]
    return pd.concat(parts, ignore_index=True)


def _collect_sym(rows, k: int):
    mat, vec, extra = np.zeros((k, k)), np.zeros(k), {}
    for r in rows:
        if r.i == -1:
            vec[r.j] = r.v
        elif r.i == -2:
            extra[r.j] = r.v
        else:
            mat[r.i, r.j] = r.v
            mat[r.j, r.i] = r.v
    return mat, vec, extra


#: The event studied by default, its date and the states that it struck.
DEFAULT_EVENT, DEFAULT_DATE, DEFAULT_STATES = "bird_flu_2024", "2024-02-01", ("IA", "MO", "MN")


def did(history: DataFrame, event: str = DEFAULT_EVENT, event_date: str = DEFAULT_DATE,
        treated_states: list[str] | None = None, item_category: str | None = "Eggs", window_weeks: int = 4,
        rcond: float = 1e-10) -> DataFrame:
    """ATT with store and date fixed effects, HC1 errors, normal p and 95 % CI (one row).

    The panel is read once, into stored (store, date) cells; counts, Gram matrix and the variance come from
    them.  Where the effect is not identified (it is absorbed by store or date effects), the ATT is that of the minimum-norm
    solution of the regression on an intercept, treatment, post, their product
    and treatment-coded store and date effects: `_MinimumNorm`.
    """
    spark: SparkSession = history.sparkSession
    treated_states = treated_states or list(DEFAULT_STATES)
    panel = did_panel(history, event_date, treated_states, item_category, window_weeks)
    day0 = dt.date.fromisoformat(event_date)
    start = day0 - dt.timedelta(weeks=window_weeks)
    k = 1 + 14 * window_weeks + 1
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = store(did_cells(panel).select(
        "store_id", F.datediff("price_date", F.lit(start)).alias("tau"), "n", F.col("sum_y").cast("double").alias("sum_y"),
        F.col("sum_y2").cast("double").alias("sum_y2"), "d", "treatment",
        F.pmod(F.hash("store_id"), F.lit(buckets)).alias("_b")), "did-cells")

    def gram(pdf: pd.DataFrame) -> pd.DataFrame:
        g, b, totals, seen = np.zeros((k, k)), np.zeros(k), np.zeros((k + 3, k + 3)), np.zeros(k + 3)
        for _, grp in pdf.groupby("store_id", sort=False, dropna=False):
            zt, n, sy, _, ybar = _design(grp, k)
            g += (zt * n[:, None]).T @ zt
            b += zt.T @ (sy - n * ybar)
            w = _store_row(grp, k)
            totals += np.outer(w, w)
            seen[:3] += [n.sum(), w[1], 1 - w[1]]
            np.add.at(seen, 4 + grp["tau"].to_numpy(np.int64), n)
        return pd.concat([_emit(g, b, []), _emit(totals, seen, []).assign(i=lambda x: x["i"] + 1000)], ignore_index=True)

    rows = cells.groupBy("_b").applyInPandas(gram, _PARTIAL).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    g, b, _ = _collect_sym([r for r in rows if r.i < 900], k)
    totals, seen = np.zeros((k + 3, k + 3)), np.zeros(k + 3)
    for r in rows:
        if r.i >= 1000:
            totals[r.i - 1000, r.j] = totals[r.j, r.i - 1000] = r.v
        elif r.i == 999:
            seen[r.j] = r.v
    n_obs, n_treated, n_control = (int(round(v)) for v in seen[:3])
    base = {"event": event, "event_date": event_date, "n_obs": n_obs, "n_treated_stores": n_treated,
            "n_control_stores": n_control}
    if n_obs == 0:
        return _did_row(spark, base, None, None, None)
    first = cells.filter(F.col("store_id").eqNullSafe(cells.select(F.min("store_id")).scalar())).toPandas()  # one store's cells
    ginv = np.linalg.pinv(g, rcond=rcond, hermitian=True)
    rank = int(np.linalg.matrix_rank(g, tol=1e-8 * max(1.0, np.abs(g).max()), hermitian=True))
    beta = ginv @ b
    post = np.arange(k - 1) >= 7 * window_weeks
    norm = _MinimumNorm(g, totals, _store_row(first, k), seen[4:] > 0, post)
    att = norm.effect(beta)

    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        total = 0.0
        for _, grp in pdf.groupby("store_id", sort=False, dropna=False):
            zt, n, sy, syy, ybar = _design(grp, k)
            c = ybar + zt @ beta
            rss = syy - 2 * c * sy + n * c * c
            weight = zt @ (ginv @ norm.on_reduced) + norm.on_store(_store_row(grp, k)) / n.sum()
            total += float((weight * weight * rss).sum())
        return pd.DataFrame({"i": [0], "j": [0], "v": [total]})

    if n_obs <= n_treated + n_control + rank:
        return _did_row(spark, base, att, None, None)
    var = cells.groupBy("_b").applyInPandas(spread, _PARTIAL).agg(F.sum("v")).first()[0]
    var *= n_obs / (n_obs - n_treated - n_control - rank)
    se = math.sqrt(max(var, 0.0))
    return _did_row(spark, base, att, se if se > 1e-12 * max(1.0, abs(att)) else None, rank)


def _store_row(group: pd.DataFrame, k: int) -> np.ndarray:
    """(1, treated, mean of y, means of the k regressors) of one store."""
    n = group["n"].to_numpy(np.float64)
    z = np.zeros((len(group), k))
    z[:, 0] = group["d"].to_numpy(np.float64)
    z[np.arange(len(group)), 1 + group["tau"].to_numpy(np.int64)] = 1.0
    return np.concatenate([[1.0, float(group["treatment"].max()), group["sum_y"].sum() / n.sum()], (n @ z) / n.sum()])


class _MinimumNorm:
    """The effect in the minimum-norm solution, from what the reduced regression (stores demeaned) leaves.

    Any solution has store effects m_s = ybar_s - zbar_s b.  Directions that change no fitted value are: treatment
    against its stores, post against its dates, and the null vectors of the reduced Gram matrix with
    the store effects that offset them.  The minimum-norm solution is the one without a part along them; lengths are
    those of the treatment-coded coefficients, whose sums over stores come from `totals`
    (sums of w w' over stores, w = (1, treated, ybar, zbar)).  So the number of stores does not matter here.
    """

    def __init__(self, g: np.ndarray, totals: np.ndarray, first: np.ndarray, seen: np.ndarray, post: np.ndarray):
        k = len(g)
        self.totals, self.first, self.k = totals, first, k
        self.days = np.flatnonzero(seen)
        value, vector = np.linalg.eigh(g)
        null = vector[:, value <= 1e-9 * max(1.0, float(np.abs(value).max()))]
        unused = np.flatnonzero(~seen) + 1  # days without rows have no coefficient
        null[unused] = 0.0
        # a direction: (on the product, treatment, post, days, and weights of w that give the store effects)
        self.directions = [(0.0, 1.0, 0.0, np.zeros(k - 1), self._weights(treated=-1.0)),
                           (0.0, 0.0, 1.0, -post.astype(float), self._weights())]
        for u in null.T:
            self.directions.append((float(u[0]), 0.0, 0.0, u[1:].copy(), self._weights(z=-u)))
        dots = np.array([[self._dot(a, b) for b in self.directions] for a in self.directions])
        along = np.array([d[0] for d in self.directions])
        self.share = np.linalg.pinv(dots, rcond=1e-9, hermitian=True) @ along  # effect = b_D - share . dots(directions, solution)
        self.on_reduced, self.store_weights = self._linear()

    def _weights(self, treated: float = 0.0, y: float = 0.0, z: np.ndarray | None = None) -> np.ndarray:
        return np.concatenate([[0.0, treated, y], np.zeros(self.k) if z is None else z])

    def _dot(self, a: tuple, b: tuple) -> float:
        """The product of two coefficient vectors in treatment coding: intercept, store and date effects against the first ones."""
        da, db = a[3][self.days], b[3][self.days]
        ma, mb = self.first @ a[4], self.first @ b[4]
        stores = a[4] @ self.totals @ b[4] - ma * (self.totals[0] @ b[4]) - mb * (self.totals[0] @ a[4]) + ma * mb * self.totals[0, 0]
        dates = float((da - da[0]) @ (db - db[0]))
        return a[0] * b[0] + a[1] * b[1] + a[2] * b[2] + (ma + da[0]) * (mb + db[0]) + stores + dates

    def solution(self, beta: np.ndarray) -> tuple:
        return float(beta[0]), 0.0, 0.0, beta[1:], self._weights(y=1.0, z=-beta)

    def effect(self, beta: np.ndarray) -> float:
        found = self.solution(beta)
        return float(beta[0] - self.share @ np.array([self._dot(d, found) for d in self.directions]))

    def _linear(self) -> tuple[np.ndarray, tuple]:
        """The effect as a linear form: weights on b and on each store's m_s (as weights of w, and at the first store)."""
        k = self.k
        on_b, slope, at_first = np.zeros(k), np.zeros(k + 3), 0.0
        on_b[0] = 1.0
        for s, d in zip(self.share, self.directions, strict=True):
            days = np.zeros(k - 1)
            dd = d[3][self.days]
            m1 = float(self.first @ d[4])
            days[self.days] = dd - dd[0]
            days[self.days[0]] += (m1 + dd[0]) - float((dd - dd[0]).sum())
            on_b[0] -= s * d[0]
            on_b[1:] -= s * days
            slope -= s * (d[4] - m1 * np.eye(k + 3)[0])  # on m_s: the direction's store effect against the first store's
            at_first -= s * ((m1 + dd[0]) - float(self.totals[0] @ d[4] - m1 * self.totals[0, 0]))
        # m_s = ybar_s - zbar_s b: what b takes from the store effects
        means = slope @ self.totals[:, 3:] + at_first * self.first[3:]
        return on_b - means, (slope, at_first)

    def on_store(self, w: np.ndarray) -> float:
        slope, at_first = self.store_weights
        return float(w @ slope) + (at_first if np.array_equal(w, self.first) else 0.0)


def _did_row(spark: SparkSession, base: dict, att, se, rank) -> DataFrame:
    p = stats.normal_two_sided_p(att / se) if (att is not None and se) else None
    lo = round(att - stats.Z_975 * se, 4) if se else None
    hi = round(att + stats.Z_975 * se, 4) if se else None
    row = {**base, "att": None if att is None else round(att, 4), "se": None if se is None else round(se, 6),
           "pvalue": None if p is None else round(p, 6), "conf_int_lower": lo, "conf_int_upper": hi,
           "rank": rank}
    schema = ("event string, event_date string, att double, se double, pvalue double, conf_int_lower double, "
              "conf_int_upper double, n_obs long, n_treated_stores long, n_control_stores long, rank int")
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(row[c] for c in cols)], schema)


# ---------------------------------------------------------------------------
# Regression discontinuity
# ---------------------------------------------------------------------------


def add_running_variable(df: DataFrame, threshold_type: str, date_col: str = "price_date") -> DataFrame:
    d = F.col(date_col)
    if threshold_type == "month_end":
        return df.withColumn("running_var", scalars.days_to_month_end(d))
    if threshold_type == "day_of_year":
        return df.withColumn("running_var", scalars.day_of_year_centered(d))
    raise ValueError(f"no running variable is defined for {threshold_type!r}")


def local_linear_rdd(df: DataFrame, running_col: str = "running_var", outcome_col: str = "is_on_sale",
                     bandwidth: int = 7) -> DataFrame:
    """Interacted local-linear fit = one line per side; jump = right intercept - left intercept.

    Works on the (x, y) groups inside the bandwidth (at most (2h+1) x distinct y rows),
    so every sum after the first aggregation runs over a handful of rows.
    HC3: Var = sum c_i^2 e_i^2 / (1 - h_i)^2 over both sides; NULL if some h_i = 1.
    """
    x = F.col(running_col).cast("long")
    grp = df.filter(F.abs(x) <= bandwidth).groupBy(
        x.alias("x"), F.col(outcome_col).cast("double").alias("y")
    ).agg(F.count(F.lit(1)).alias("c")).withColumn("side", (F.col("x") >= 0).cast("int"))
    side = grp.groupBy("side").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.col("x")).alias("sx"), F.sum(F.col("c") * F.col("y")).alias("sy"),
        F.sum(F.col("c") * F.col("x") * F.col("x")).alias("sxx_raw"),
        F.sum(F.col("c") * F.col("x") * F.col("y")).alias("sxy_raw"),
    )
    side = side.select(
        "side", "n",
        (F.col("sx") / F.col("n")).alias("xbar"),
        ((F.col("n") * F.col("sxx_raw") - F.col("sx") * F.col("sx")).cast("double") / F.col("n")).alias("sxx"),
        ((F.col("n") * F.col("sxy_raw") - F.col("sx") * F.col("sy")) / F.col("n")).alias("sxy"),
        "sy", "sx",
    ).withColumn("b", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(F.lit(0.0))).withColumn(
        "a", (F.col("sy") - F.col("b") * F.col("sx")) / F.col("n"))
    rows = grp.join(side, "side")
    has_slope = F.col("sxx") > 0
    dev = F.col("x") - F.col("xbar")
    h = F.when(has_slope, 1.0 / F.col("n") + dev * dev / F.col("sxx")).otherwise(1.0 / F.col("n"))
    cw = F.when(has_slope, 1.0 / F.col("n") - F.col("xbar") * dev / F.col("sxx")).otherwise(1.0 / F.col("n"))
    e = F.col("y") - F.col("a") - F.col("b") * F.col("x")
    contrib = rows.select(
        "side",
        F.when(h < 1 - 1e-12, F.col("c") * cw * cw * e * e / ((1 - h) * (1 - h))).alias("v"),
        (h >= 1 - 1e-12).alias("lever1"),
    ).groupBy("side").agg(F.sum("v").alias("var"), F.max(F.col("lever1").cast("int")).alias("lever1"))
    per_side = side.join(contrib, "side")
    right, left = F.col("side") == 1, F.col("side") == 0
    out = per_side.agg(
        F.sum(F.when(right, F.col("a"))).alias("a_r"), F.sum(F.when(left, F.col("a"))).alias("a_l"),
        F.sum("var").alias("var"), F.max("lever1").alias("lever1"),
        F.sum(F.when(left, F.col("n"))).alias("n_left"), F.sum(F.when(right, F.col("n"))).alias("n_right"),
        F.count(F.lit(1)).alias("sides"),
    )
    return out.select(
        (F.col("a_r") - F.col("a_l")).alias("jump"),
        F.when((F.col("lever1") == 0) & (F.col("sides") == 2), F.sqrt("var")).alias("se"),
        F.coalesce("n_left", F.lit(0)).cast("long").alias("n_left"),
        F.coalesce("n_right", F.lit(0)).cast("long").alias("n_right"),
        F.lit(bandwidth).alias("bandwidth"),
    )


def rdd_window(history: DataFrame, as_of: str, years: int = 2) -> DataFrame:
    return history.filter(
        (F.col("price_date") >= F.add_months(F.lit(as_of).cast("date"), -12 * years))
        & F.col("regular_price").isNotNull()
    )


def rdd(history: DataFrame, threshold_type: str = "month_end", as_of: str | None = None,
        bandwidth: int = 7) -> DataFrame:
    """M14 (comparable part): jump and HC3 SE rounded to 6, counts, n_total."""
    as_of = as_of or dt.date.today().isoformat()
    data = add_running_variable(rdd_window(history, as_of), threshold_type)
    est = local_linear_rdd(data, bandwidth=bandwidth)
    n_total = data.select(F.count(F.lit(1))).scalar()
    return est.select(
        F.lit(threshold_type).alias("threshold_type"),
        (F.round("jump", 6) + 0.0).alias("jump_estimate"),
        (F.round("se", 6) + 0.0).alias("se"),
        "n_left", "n_right", n_total.alias("n_total"), "bandwidth",
    )


def rdd_report(history: DataFrame, threshold_type: str = "month_end", as_of: str | None = None,
               bandwidth: int = 7) -> DataFrame:
    """M14 as reported: adds the normal p-value of jump / se."""
    r = rdd(history, threshold_type, as_of, bandwidth)
    return r.withColumn("pvalue", F.round(stats.normal_p_udf(F.col("jump_estimate") / F.col("se")), 6))
