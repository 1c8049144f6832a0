"""Correlation, regression, analysis of variance and effect size of the reports."""

from __future__ import annotations

from delaykit.operators import statistics as st
from delaykit.plans.catalog import ROW_DIGITS, query
from delaykit.plans.report_queries import report
from delaykit.plans.views import with_views

_ALL = (st.TARGET,) + st.FACTORS


def _corr(x: str, y: str) -> str:
    return f"CASE WHEN var_samp({x}) > 0 AND var_samp({y}) > 0 THEN corr({x}, {y}) END"


@query(
    "correlation_matrix",
    with_views(
        "dcm",
        " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, {_corr(a, b)} AS corr FROM dcm" for a in _ALL for b in _ALL),
    ),
    ["corr"],
)
def _(spark, path):
    return st.correlation_matrix(report(spark, path))


# Terms of the series that the p-values are checked against.
_TERMS = 400_000


def _beta(columns: str, a: str, b: str, x: str, source: str) -> str:
    """``columns`` of ``source`` and ``p_value``, the incomplete beta function by its power series."""
    return f"""SELECT {columns}, p_value, CASE WHEN p_value < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM (
      SELECT {columns}, CASE WHEN swapped THEN 1 - total ELSE total END AS p_value FROM (
        SELECT {columns}, swapped,
          sum(exp(a * ln(x) + b * ln(1 - x) + lgamma(a + b + k) - lgamma(a + 1 + k) - lgamma(b) + k * ln(x))) AS total
        FROM (SELECT {columns}, swapped, CASE WHEN swapped THEN b ELSE a END AS a,
            CASE WHEN swapped THEN a ELSE b END AS b, CASE WHEN swapped THEN 1 - x ELSE x END AS x
          FROM (SELECT *, x > (a + 1) / (a + b + 2) AS swapped
            FROM (SELECT *, {a} AS a, {b} AS b, {x} AS x FROM {source}) t1) t2) t3, range(0, {_TERMS}) r(k)
        GROUP BY ALL) t4) t5"""


_FACTORS = " UNION ALL ".join(
    f"SELECT '{f}' AS factor, count(*) AS n, corr({f}, {st.TARGET}) AS r FROM dcm" for f in st.FACTORS
)


_JUDGED = "SELECT factor, n, r AS corr, r * r AS r2, r * sqrt((n - 2) / (1 - r * r)) AS t_stat FROM f"


@query("factor_significance", with_views("dcm", _JUDGED, f=_FACTORS), ["corr", "r2", "t_stat"])
def _(spark, path):
    return st.factor_significance(report(spark, path))


@query(
    "factor_pvalues",
    with_views(
        "dcm",
        _beta(
            "factor, n, corr, r2, t_stat", "(n - 2) / 2.0E0", "0.5E0", "(n - 2) / (n - 2 + t_stat * t_stat)", "judged"
        ),
        f=_FACTORS,
        judged=_JUDGED,
    ),
    ["corr", "r2", "t_stat", "p_value"],
)
def _(spark, path):
    return st.factor_pvalues(st.factor_significance(report(spark, path)))


@query(
    "regression_params",
    with_views(
        "dcm",
        " UNION ALL ".join(
            f"SELECT '{f}' AS factor, regr_slope({st.TARGET}, {f}) AS slope, regr_intercept({st.TARGET}, {f}) AS intercept, "
            f"regr_r2({st.TARGET}, {f}) AS r2 FROM dcm"
            for f in st.LINE_FACTORS
        ),
    ),
    ["slope", "intercept", "r2"],
)
def _(spark, path):
    return st.regression_params(report(spark, path))


@query(
    "regression_line",
    with_views(
        "dcm",
        " UNION ALL ".join(
            f"SELECT '{f}' AS factor, CAST({f} AS DOUBLE) AS x, {st.TARGET} AS y, (SELECT regr_intercept({st.TARGET}, {f}) FROM dcm) "
            f"+ (SELECT regr_slope({st.TARGET}, {f}) FROM dcm) * {f} AS predicted FROM dcm"
            for f in st.LINE_FACTORS
        ),
    ),
    ["x", "y", "predicted"],
    digits=ROW_DIGITS,
)
def _(spark, path):
    return st.regression_line(report(spark, path))


_GROUPS = f"SELECT carrier_name AS g, count(*) AS n, avg({st.TARGET}) AS m, var_samp({st.TARGET}) AS v FROM dcm GROUP BY 1"


_ANOVA = """SELECT count(*) - 1 AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within,
  (sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))) AS f_stat
FROM (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS grand FROM g) t"""


@query("anova_by_carrier", with_views("dcm", _ANOVA, g=_GROUPS), ["f_stat"])
def _(spark, path):
    return st.anova(report(spark, path))


@query(
    "anova_by_carrier_pvalue",
    with_views(
        "dcm",
        _beta(
            "df_between, df_within, f_stat", "df_within / 2.0E0", "df_between / 2.0E0",
            "df_within / (df_within + df_between * f_stat)", "tested",
        ),
        g=_GROUPS,
        tested=_ANOVA,
    ),
    ["f_stat", "p_value"],
)
def _(spark, path):
    return st.anova_pvalue(st.anova(report(spark, path)))


_SIDES = {
    "g": _GROUPS,
    "top": f"SELECT {st.TARGET} AS y FROM dcm WHERE carrier_name IN (SELECT g FROM g ORDER BY m DESC, g LIMIT 5)",
    "bottom": f"SELECT {st.TARGET} AS y FROM dcm WHERE carrier_name IN (SELECT g FROM g ORDER BY m, g DESC LIMIT 5)",
    "s": """SELECT t.n AS tn, t.m AS tm, t.s AS ts, b.n AS bn, b.m AS bm, b.s AS bs,
      ((t.n - 1) * t.s * t.s + (b.n - 1) * b.s * b.s) / (t.n + b.n - 2) AS pooled
      FROM (SELECT count(*) AS n, avg(y) AS m, stddev_samp(y) AS s FROM top) t,
        (SELECT count(*) AS n, avg(y) AS m, stddev_samp(y) AS s FROM bottom) b""",
}


_TTEST = """SELECT tn AS top_n, tm AS top_mean, ts AS top_std, bn AS bottom_n, bm AS bottom_mean, bs AS bottom_std,
  tn + bn - 2 AS df, (tm - bm) / sqrt(pooled * (1.0E0 / tn + 1.0E0 / bn)) AS t_stat FROM s"""
_TTEST_DOUBLES = ["top_mean", "top_std", "bottom_mean", "bottom_std", "t_stat"]


@query("top_bottom_ttest", with_views("dcm", _TTEST, **_SIDES), _TTEST_DOUBLES)
def _(spark, path):
    return st.top_bottom_ttest(st.top_bottom_moments(report(spark, path)))


@query(
    "top_bottom_ttest_pvalue",
    with_views(
        "dcm",
        _beta(
            "top_n, top_mean, top_std, bottom_n, bottom_mean, bottom_std, df, t_stat",
            "df / 2.0E0", "0.5E0", "df / (df + t_stat * t_stat)", "tested",
        ),
        **_SIDES,
        tested=_TTEST,
    ),
    [*_TTEST_DOUBLES, "p_value"],
)
def _(spark, path):
    return st.ttest_pvalue(st.top_bottom_ttest(st.top_bottom_moments(report(spark, path))))


@query(
    "cohens_d",
    with_views(
        "dcm",
        """SELECT d AS cohens_d, CASE WHEN abs(d) > 0.8 THEN 'Large' WHEN abs(d) > 0.5 THEN 'Medium' ELSE 'Small' END AS effect
        FROM (SELECT (tm - bm) / sqrt(pooled) AS d FROM s) t""",
        **_SIDES,
    ),
    ["cohens_d"],
)
def _(spark, path):
    return st.cohens_d(st.top_bottom_moments(report(spark, path)))
