"""Queries: grouped statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens import fixed
from carelens.operators import cluster, stats
from carelens.plans import summaries
from workload.q_jobs import _SITES, FACTORS_SQL, LAST_MONTH, REGRESSION_SQL, active, factors, grouped, regression_inputs
from workload.registry import query, r6
from workload.views import table, view

SUBSCALES = sorted({s for _, _, s, _ in fixed.SURVEY_ITEMS})
LEVELS = ["inner", "outer", "patient", "staff"]


def _p(t: str, v: str) -> str:
    """Two-sided t probability by Simpson's rule on the density."""
    return (
        f"(1 - 2 * exp(lgamma((({v}) + 1) / 2.0) - lgamma(({v}) / 2.0)) / sqrt(pi() * ({v})) * abs({t}) / 6000 * "
        f"list_sum(list_transform(range(2001), lambda k: (CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) "
        f"* pow(1 + pow({t} * k / 2000, 2) / ({v}), -(({v}) + 1) / 2.0))))"
    )


def _rank_p() -> str:
    """The series for untied ranks, written from the sum of squared differences; normal tails by Simpson's rule."""
    s = "round((pow(n, 3) - n) * (1 - cor) / 6)"
    up = f"({s} > (pow(n, 3) - n) / 6)"
    x = f"((6 * (CASE WHEN {up} THEN {s} - 1 ELSE {s} + 1 END) / n / (n * n - 1) - 1) * sqrt(n - 1))"
    u = (
        f"({x} / n * (0.2274 + (0.2531 + 0.1745 / n) / n + pow({x}, 2) * (-0.0758 + (0.1033 + 0.3932 / n) / n - pow({x}, 2) / n * "
        f"(0.0879 + 0.0151 / n - pow({x}, 2) * (0.0072 - 0.0831 / n + pow({x}, 2) / n * (0.0131 - 4.6e-4 * pow({x}, 2)))))) / exp(pow({x}, 2) / 2))"
    )
    inner = (
        f"({x} / 6000 * list_sum(list_transform(range(2001), lambda k: (CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) "
        f"* exp(-pow({x} * k / 2000, 2) / 2))) / sqrt(2 * pi()))"
    )
    return f"least(1, 2 * CASE WHEN {up} THEN 0.5 - {inner} + {u} ELSE 0.5 + {inner} - {u} END)"


def _spearman(rows: str, keys: str) -> str:
    """Rank correlation by keys of rows (keys, x, y)."""
    part = f"PARTITION BY {keys}" if keys else ""
    both = f"PARTITION BY {keys}, " if keys else "PARTITION BY "
    out = f"{keys}, " if keys else ""
    return f"""pairs AS ({rows}),
ranks AS (SELECT {out}rank() OVER ({part} ORDER BY x) + (count(*) OVER ({both}x) - 1) / 2.0 AS rx,
  rank() OVER ({part} ORDER BY y) + (count(*) OVER ({both}y) - 1) / 2.0 AS ry FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL),
cors AS (SELECT {out}count(*) AS n, corr(rx, ry) AS cor, count(DISTINCT rx) = count(*) AND count(DISTINCT ry) = count(*) AND count(*) BETWEEN 10 AND 1290 AS no_ties FROM ranks {"GROUP BY " + keys if keys else ""}),
ts AS (SELECT *, cor * sqrt(n - 2) / sqrt(1 - cor * cor) AS t FROM cors)
SELECT {out}n, round(cor, 6) + 0.0 AS cor, round(CASE WHEN no_ties THEN {_rank_p()} ELSE {_p("t", "n - 2")} END, 6) + 0.0 AS p_val FROM ts"""


@query("stat_spearman", "WITH " + _spearman("SELECT l_returnflag, l_quantity AS x, l_tax AS y FROM lineitem", "l_returnflag"))
def _(spark, d):
    return r6(stats.spearman_by(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_tax"))


@query("job_subscale_vs_reach", f"WITH {_SITES}, " + _spearman(f"""
SELECT subscale, subscale_val AS x, b4 / b1 * 100 AS y FROM (SELECT program_id, subscale, subscale_val FROM sites UNION ALL
  SELECT program_id, 'total', total_val FROM totals) s LEFT JOIN (SELECT * FROM v_month WHERE date = DATE '{LAST_MONTH}') m USING (program_id)""", "subscale"))
def _(spark, d):
    return r6(summaries.subscale_vs_reach(grouped(spark, d), view(spark, d, "v_long"), LAST_MONTH))


@query("job_total_vs_imat", f"WITH {_SITES}, " + _spearman(f"""
SELECT total_val AS x, value AS y FROM totals LEFT JOIN (SELECT program_id, value FROM v_long WHERE variable = 'imat_total') i USING (program_id)""", ""))
def _(spark, d):
    return r6(summaries.total_vs_imat(grouped(spark, d), view(spark, d, "v_long")))


_GRID = " UNION ALL ".join(
    f"""SELECT '{o}' AS outcome, '{e}' AS exposure, regr_count("{o}", {e})::BIGINT AS n, regr_slope("{o}", {e}) AS b,
  regr_sxx("{o}", {e}) AS sxx, regr_r2("{o}", {e}) AS r2 FROM inputs"""
    for o in ("count_MOUD", "pct_MOUD") for e in ("mean_likert", "barriers", "facilitators")
)


@query("stat_linear_grid", f"""
WITH {REGRESSION_SQL}, fits AS ({_GRID}), ts AS (SELECT *, sign(b) * sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM fits)
SELECT outcome, exposure, n, round(b, 6) + 0.0 AS estimate, round({_p("t", "n - 2")}, 6) + 0.0 AS p_val FROM ts""")
def _(spark, d):
    return r6(summaries.regression_grid(regression_inputs(spark, d)))


def _reml_sql(rows: str, key: str) -> str:
    """REML by halving on the analytic derivative of the criterion; the clusters of a group are a list.

    b is a cluster's weight, n / (1 + lam n), whose derivative is -b * b.
    """

    def over(expr: str) -> str:
        body = expr.replace("$b", "(k.n / (1 + lam * k.n))")
        return f"list_sum(list_transform(c, lambda k: {body}))"

    def score(source: str) -> str:
        sums = ", ".join(
            f"{over(e)} AS {n}" for n, e in [
                ("a11", "$b"), ("a1x", "$b * k.mx"), ("axx", "k.wxx + $b * k.mx * k.mx"), ("a1y", "$b * k.my"),
                ("axy", "k.wxy + $b * k.mx * k.my"), ("ayy", "k.wyy + $b * k.my * k.my"),
                ("b11", "$b * $b"), ("b1x", "$b * $b * k.mx"), ("bxx", "$b * $b * k.mx * k.mx")]
        )
        return f"""(SELECT *, lam * (free * drss / rss + a11 + ddet / det) AS score, lam * drss / rss AS r1, lam * (-ddet / det - b11 / a11) AS c1,
    slope / sqrt(rss / free * a11 / det) AS t FROM (
  SELECT *, ayy - level * a1y - slope * axy AS rss, -{over("$b * $b * pow(k.my - level - slope * k.mx, 2)")} AS drss,
    -(b11 * axx + a11 * bxx - 2 * a1x * b1x) AS ddet FROM (
  SELECT *, (a11 * axy - a1x * a1y) / det AS slope, (axx * a1y - a1x * axy) / det AS level FROM (
  SELECT *, a11 * axx - a1x * a1x AS det FROM (SELECT *, {sums} FROM {source})))))"""

    return f"""reml_stats AS (SELECT {key}, site_group, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y)::DOUBLE AS my, sum(x * x) - sum(x) * sum(x) / count(*) AS wxx,
    (sum(x * y) - sum(x) * sum(y) / count(*))::DOUBLE AS wxy, (sum(y * y) - sum(y) * sum(y) / count(*))::DOUBLE AS wyy
  FROM (SELECT {key}, site_group, y::DOUBLE AS y, CASE type WHEN 'SUD' THEN 1.0::DOUBLE ELSE 0 END AS x FROM ({rows}) WHERE y IS NOT NULL) GROUP BY ALL),
reml_lists AS (SELECT {key}, list({{'n': n, 'mx': mx, 'my': my, 'wxx': wxx, 'wxy': wxy, 'wyy': wyy}}) AS c, sum(n) - 2 AS free, count(*) AS clusters
  FROM reml_stats GROUP BY {key} HAVING sum(n) > 2 AND count(DISTINCT mx) > 1),
halving AS (SELECT 0 AS step, {key}, c, free, clusters, -69.0::DOUBLE AS lo, 41.0::DOUBLE AS hi FROM reml_lists
  UNION ALL SELECT step + 1, {key}, c, free, clusters, CASE WHEN score < 0 THEN ln(lam) ELSE lo END, CASE WHEN score < 0 THEN hi ELSE ln(lam) END
  FROM {score("(SELECT *, exp((lo + hi) / 2) AS lam FROM halving WHERE step < 90)")}),
found AS (SELECT {key}, c, free, clusters, CASE WHEN hi < -60 THEN 0 ELSE exp(lo) END AS lam FROM halving WHERE step = 90),
bends AS (SELECT {key}, (max(score) FILTER (side = 1) - max(score) FILTER (side = -1)) / 0.002 AS bend
  FROM {score("(SELECT {key}, c, free, clusters, side, lam * exp(side * 0.001) AS lam FROM found, (VALUES (-1), (1)) s(side))".replace("{key}", key))} GROUP BY {key}),
reml AS (SELECT {key}, slope AS estimate, t AS t_value, clusters AS n_clusters,
    CASE WHEN lam = 0 THEN free ELSE 1 / (1 / free + pow(r1 + c1, 2) / bend) END AS df FROM {score("found")} JOIN bends USING ({key}))"""


_ANSWER_ROWS = f"SELECT q_num, raw_value AS y, type, {'CASE WHEN CAST(substr(program_id, 3) AS INT) BETWEEN 53 AND 62 THEN ' + chr(39) + 'PC_group1' + chr(39) + ' ELSE program_id END'} AS site_group FROM active"


@query("stat_random_intercept", f"""
WITH RECURSIVE {_SITES}, {_reml_sql(_ANSWER_ROWS, "q_num")}
SELECT q_num, round(estimate, 5) + 0.0 AS estimate, round(t_value, 5) + 0.0 AS t_value, n_clusters, round(df, 4) AS df, round({_p("t_value", "df")}, 5) + 0.0 AS p_val FROM reml""")
def _(spark, d):
    coded = grouped(spark, d).withColumn("_is_sud", (F.col("type") == "SUD").cast("double"))
    fit = stats.random_intercept_by(coded, ["q_num"], "raw_value", "_is_sud", "site_group", "answers")
    return r6(fit, 5).withColumn("df", F.round("df", 4))


def _five(value: str, source: str, key: str) -> str:
    def cols(prefix, cond):
        f = f"FILTER ({cond})" if cond else ""
        return (
            f"round(avg({value}) {f}, 6) AS \"{prefix}_mean\", round(stddev_samp({value}) {f}, 6) AS \"{prefix}_sd\", "
            f"round(median({value}) {f}, 6)::DOUBLE AS \"{prefix}_median\", round(min({value}) {f}, 6)::DOUBLE AS \"{prefix}_min\", "
            f"round(max({value}) {f}, 6)::DOUBLE AS \"{prefix}_max\""
        )

    parts = [cols("total", ""), *[cols(t, f"type = '{t}'") for t in ("PC", "SUD")]]
    return f"SELECT {key}, {', '.join(parts)} FROM {source} GROUP BY {key}"


@query("job_question_summary", f"""
WITH RECURSIVE {_SITES}, {_reml_sql(_ANSWER_ROWS, "q_num")}, five AS ({_five("raw_value", "active", "q_num")})
SELECT five.*, round({_p("t_value", "df")}, 5) + 0.0 AS p_val FROM five LEFT JOIN reml USING (q_num)""")
def _(spark, d):
    return r6(summaries.question_summary(grouped(spark, d)).withColumn("p_val", F.round("p_val", 5)))


@query("job_subscale_summary", f"""
WITH RECURSIVE {_SITES}, {_reml_sql("SELECT subscale, subscale_val AS y, type, site_group FROM sites", "subscale")}, five AS ({_five("subscale_val", "sites", "subscale")})
SELECT five.*, round_even({_p("t_value", "df")}, 4) + 0.0 AS p_val FROM five LEFT JOIN reml USING (subscale)""")
def _(spark, d):
    return r6(summaries.subscale_summary(grouped(spark, d)))


_FACTORS = summaries.factor_columns()
_SUM = " + ".join(_FACTORS)


@query("stat_cronbach_alpha", f"""
WITH {FACTORS_SQL}
SELECT count(*) AS n, {len(_FACTORS)} AS n_items,
  round({len(_FACTORS)} / {len(_FACTORS) - 1} * (1 - ({" + ".join(f"var_samp({c})" for c in _FACTORS)}) / var_samp({_SUM})), 6) + 0.0 AS alpha
FROM j WHERE {_SUM} IS NOT NULL""")
def _(spark, d):
    return r6(stats.cronbach_alpha(factors(spark, d), _FACTORS))


def _matrix(expr: str) -> str:
    """A square matrix as lists of lists, from an expression in i and j."""
    k = len(_FACTORS)
    return f"list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 1}), lambda j: {expr}))"


_ROWS = f"range(1, {len(_FACTORS) + 1})"
_SQUARINGS = 45


@query("stat_pca", f"""
WITH RECURSIVE {FACTORS_SQL}, whole AS (SELECT {", ".join(_FACTORS)} FROM j WHERE {_SUM} IS NOT NULL),
cors AS (SELECT [{", ".join("[" + ", ".join(f"corr({a}, {b})" for b in _FACTORS) + "]" for a in _FACTORS)}] AS c FROM whole),
powers AS (
  SELECT 1 AS comp, 0 AS n, c, c AS m, NULL::DOUBLE[] AS v, NULL::DOUBLE AS l FROM cors
  UNION ALL
  SELECT CASE WHEN n = {_SQUARINGS} THEN comp + 1 ELSE comp END, CASE WHEN n = {_SQUARINGS} THEN 0 ELSE n + 1 END,
    CASE WHEN n = {_SQUARINGS} THEN rest ELSE c END, CASE WHEN n = {_SQUARINGS} THEN rest ELSE {_matrix("sq[i][j] / size")} END,
    CASE WHEN n = {_SQUARINGS} THEN vec END, CASE WHEN n = {_SQUARINGS} THEN val END
  FROM (SELECT *, {_matrix("c[i][j] - val * vec[i] * vec[j]")} AS rest FROM (
    SELECT *, list_sum(list_transform({_ROWS}, lambda i: list_sum(list_transform({_ROWS}, lambda k: vec[i] * c[i][k] * vec[k])))) AS val FROM (
    SELECT *, list_transform({_ROWS}, lambda i: m[i][top] / sqrt(list_sum(list_transform({_ROWS}, lambda k: m[k][top] * m[k][top])))) AS vec,
      list_sum(list_transform({_ROWS}, lambda i: sq[i][i])) AS size FROM (
    SELECT *, list_position(diag, list_max(diag)) AS top, {_matrix(f"list_sum(list_transform({_ROWS}, lambda k: m[i][k] * m[k][j]))")} AS sq FROM (
    SELECT *, list_transform({_ROWS}, lambda i: m[i][i]) AS diag FROM powers WHERE comp <= {len(_FACTORS)})))))),
parts AS (SELECT comp - 1 AS comp, l, list_transform(v, lambda x: x * sign(v[list_position(list_transform(v, lambda y: abs(y)), list_max(list_transform(v, lambda y: abs(y))))])) AS v
  FROM powers WHERE v IS NOT NULL)
SELECT 'PC' || comp AS component, round(sqrt(l), 6) AS sd, round(l / {len(_FACTORS)}, 6) AS proportion,
  round(sum(l) OVER (ORDER BY comp) / {len(_FACTORS)}, 6) AS cumulative, {", ".join(f"round(v[{i}], 6) + 0.0 AS {c}" for i, c in enumerate(_FACTORS, 1))}
FROM parts""")
def _(spark, d):
    return r6(stats.pca(factors(spark, d), _FACTORS))


_FEATURES = f"""{_SITES}, z AS (SELECT program_id, subscale AS feature, (subscale_val - avg(subscale_val) OVER (PARTITION BY subscale))
  / stddev_samp(subscale_val) OVER (PARTITION BY subscale) AS value FROM sites)"""


def features(spark, d):
    return summaries.site_features(active(spark, d), "subscale", SUBSCALES, distinct=True)


@query("job_site_features", f"""
WITH {_FEATURES} SELECT program_id, {", ".join(f"round(max(value) FILTER (feature = '{s}'), 6) + 0.0 AS {s}" for s in SUBSCALES)}
FROM z GROUP BY program_id""")
def _(spark, d):
    return r6(features(spark, d))


@query("stat_corr_distance", f"""
WITH {_FEATURES} SELECT a.program_id AS site_a, b.program_id AS site_b, round(1 - corr(a.value, b.value), 6) + 0.0 AS distance
FROM z a JOIN z b ON a.feature = b.feature AND a.program_id < b.program_id GROUP BY ALL""")
def _(spark, d):
    return r6(cluster.corr_distance(features(spark, d), "program_id", SUBSCALES))


def tree(spark, d, feature="subscale", names=SUBSCALES, distinct=True):
    from carelens.sources.staging import cut_lineage

    wide = cut_lineage(summaries.site_features(active(spark, d), feature, names, distinct))
    merges, leaves = cluster.hclust_complete(cluster.corr_distance(wide, "program_id", names))
    return wide, merges, leaves


def _tree_sql(z: str) -> str:
    """Complete linkage one merge at a time: the links between clusters, and the leaves of each, as lists."""
    other = "(CASE WHEN z.a = m.a THEN z.b ELSE z.a END)"
    far = f"list_filter(links, lambda w: w.a = least(m.b, {other}) AND w.b = greatest(m.b, {other}))[1].d"
    return f"""dist AS (SELECT a.program_id AS a, b.program_id AS b, 1 - corr(a.value, b.value) AS d FROM {z} a JOIN {z} b
  ON a.feature = b.feature AND a.program_id < b.program_id GROUP BY ALL),
tree AS (
  SELECT 0 AS step, (SELECT list({{'a': a, 'b': b, 'd': d}}) FROM dist) AS links,
    (SELECT list({{'c': program_id, 's': [program_id]}}) FROM (SELECT DISTINCT program_id FROM {z})) AS leaves,
    NULL::VARCHAR AS kept, NULL::VARCHAR AS absorbed, NULL::DOUBLE AS height
  UNION ALL
  SELECT step + 1,
    list_transform(list_filter(links, lambda z: z.a <> m.b AND z.b <> m.b), lambda z: {{'a': z.a, 'b': z.b,
      'd': CASE WHEN z.a = m.a OR z.b = m.a THEN greatest(z.d, {far}) ELSE z.d END}}),
    list_transform(list_filter(leaves, lambda x: x.c <> m.b), lambda x: {{'c': x.c,
      's': CASE WHEN x.c = m.a THEN list_concat(x.s, list_filter(leaves, lambda w: w.c = m.b)[1].s) ELSE x.s END}}),
    m.a, m.b, m.d
  FROM (SELECT *, list_sort(list_transform(links, lambda x: {{'d': x.d, 'a': x.a, 'b': x.b}}))[1] AS m FROM tree WHERE len(links) > 0))"""


@query("stat_hclust_complete", f"""
WITH RECURSIVE {_FEATURES}, {_tree_sql("z")}
SELECT kept, absorbed, round(height, 6) + 0.0 AS height FROM tree WHERE step > 0""")
def _(spark, d):
    return r6(tree(spark, d)[1])


@query("stat_profile_heat", f"""
WITH RECURSIVE {_SITES}, means AS (SELECT program_id, level AS feature, avg(raw_value) AS v FROM active GROUP BY ALL),
y AS (SELECT program_id, feature, (v - avg(v) OVER (PARTITION BY feature)) / stddev_samp(v) OVER (PARTITION BY feature) AS value FROM means),
{_tree_sql("y")}
SELECT program_id, feature, round(value, 6) + 0.0 AS value, list_position(leaves[1].s, program_id)::BIGINT AS position
FROM y, (SELECT leaves FROM tree ORDER BY step DESC LIMIT 1)""")
def _(spark, d):
    wide, _, leaves = tree(spark, d, "level", LEVELS, False)
    return r6(cluster.heat_rows(wide, "program_id", LEVELS, leaves))
