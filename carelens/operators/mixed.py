"""Straight lines with a random intercept by cluster, fitted by REML from sums by cluster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.tdist import two_sided_p
from carelens.operators.exact import WHOLE, exact_sum, power_above
from carelens.sources.staging import stage

# ln(variance ratio): from where a ratio is as good as none to where the fit is its limit, to the last digit of a double.
LOWEST, HIGHEST, DECADE = -30, 18, 2.302585092994046
FINE = 20  # points of the second search on each side of the first one's lowest
STEPS = 4  # of Newton's method
MOMENTS = ["1", "x", "y", "xx", "xy", "yy"]


def _cluster_sums(df: DataFrame, keys: list[str], y: str, x: str, cluster: str, weight: str | None) -> DataFrame:
    """n, means of x and y, and sums of squares and products within, by (group, cluster).

    Whole numbers are added as such.  Others are divided by a power of two above the largest, which is found first, and
    added in limbs; either way the sums do not depend on the order of the rows.
    """
    kinds = dict(df.dtypes)
    w = F.col(weight) if weight else F.lit(1)
    rows = df.select(*keys, F.col(cluster).alias("_c"), F.col(y).alias("_yv"), F.col(x).alias("_xv"), w.alias("_w"))
    rows = rows.filter("_yv is not null and _xv is not null and not isnan(double(_yv)) and not isnan(double(_xv))")
    whole = all(kinds[c] in WHOLE for c in (y, x, weight) if c)
    if whole:
        above_x = above_y = 1.0
        term = lambda *of: F.sum(reduce(lambda a, b: a * b, [F.col(c).cast("long") for c in of], F.col("_w").cast("long"))).cast("double")
    else:
        top = rows.agg(F.max(F.abs(F.col("_xv").cast("double"))), F.max(F.abs(F.col("_yv").cast("double")))).first()
        above_x, above_y = map(power_above, top)
        rows = rows.withColumns({"_xv": F.col("_xv").cast("double") / above_x, "_yv": F.col("_yv").cast("double") / above_y})
        term = lambda *of: exact_sum(reduce(lambda a, b: a * b, [F.col(c) for c in of], F.col("_w").cast("double")))
    sums = rows.groupBy(*keys, "_c").agg(
        term().alias("_n"), term("_xv").alias("_x"), term("_yv").alias("_y"),
        term("_xv", "_xv").alias("_x_x"), term("_xv", "_yv").alias("_x_y"), term("_yv", "_yv").alias("_y_y"),
    )
    n = F.col("_n")

    def within(v):
        """Sum of squares within the cluster; what only rounding leaves is none."""
        squares = F.col(v + v)
        rest = squares - F.col(v) * F.col(v) / n
        return F.when(rest > 1e-12 * squares, rest).otherwise(0.0)

    both = F.when((F.col("_wxx") > 0) & (F.col("_wyy") > 0), F.col("_x_y") - F.col("_x") * F.col("_y") / n).otherwise(0.0)
    return sums.withColumns({"_wxx": within("_x"), "_wyy": within("_y")}).select(
        *keys, "_n", (F.col("_x") / n * above_x).alias("_mx"), (F.col("_y") / n * above_y).alias("_my"),
        (F.col("_wxx") * above_x**2).alias("_wxx"), (F.col("_wyy") * above_y**2).alias("_wyy"), (both * (above_x * above_y)).alias("_wxy"),
    )


def _by_size(stats: DataFrame, keys: list[str]) -> DataFrame:
    """A row per group with its sums by cluster size, in the order of sizes: all that the criterion needs.

    A group of m rows has at most about the root of 2 m different sizes.  Sums are exact, as by cluster.
    """
    n = F.col("_n")
    spread = lambda v: F.max(F.sqrt(F.col(f"_w{v}{v}") / n + F.col(f"_m{v}") * F.col(f"_m{v}")))
    above_n, above_x, above_y = map(power_above, stats.agg(F.max("_n"), spread("x"), spread("y")).first())  # three numbers
    x, y = F.col("_mx") / above_x, F.col("_my") / above_y
    terms = {"x": x, "y": y, "xx": x * x, "xy": x * y, "yy": y * y}
    scale = {"x": above_x, "y": above_y, "xx": above_x**2, "xy": above_x * above_y, "yy": above_y**2}
    within = {f"w{v}": F.col(f"_w{v}") / (above_n * scale[v]) for v in ("xx", "xy", "yy")}
    rows = stats.withColumns({f"_t_{k}": v for k, v in (terms | within).items()})
    sums = rows.groupBy(*keys, "_n").agg(
        F.count(F.lit(1)).cast("double").alias("1"),
        *[(exact_sum(F.col(f"_t_{k}"), bits=28) * scale[k]).alias(k) for k in terms],
        *[(exact_sum(F.col(f"_t_{k}"), bits=28) * (above_n * scale[k[1:]])).alias(k) for k in within],
    )
    sizes = F.sort_array(F.collect_list(F.struct("_n", *MOMENTS, *within)))
    return sums.groupBy(*keys).agg(sizes.alias("_sizes"))


def _let(name: str, value: str, body: str) -> str:
    """SQL: an expression of a value that is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _left_over(p: list[str], q: list[str], r: list[str], t: list[str]) -> list[str]:
    """SQL: p - q r / t, and its first and second derivative where those of the parts are given."""
    bottom = f"nullif({t[0]}, 0D)"
    out = [f"{p[0]} - {q[0]} * {r[0]} / {bottom}"]
    if len(p) > 1:
        slope = f"({q[1]} * {r[0]} + {q[0]} * {r[1]})"
        bend = f"({q[2]} * {r[0]} + 2 * {q[1]} * {r[1]} + {q[0]} * {r[2]})"
        ratio, turn, product = f"({t[1]} / {bottom})", f"({t[2]} / {bottom})", f"{q[0]} * {r[0]}"
        out.append(f"{p[1]} - ({slope} - {product} * {ratio}) / {bottom}")
        out.append(f"{p[2]} - ({bend} - 2 * {slope} * {ratio} - {product} * ({turn} - 2 * {ratio} * {ratio})) / {bottom}")
    return out


def _fit(at: str, bends: bool = False) -> str:
    """SQL: the fit of ``_sizes`` at ln(variance ratio) ``at``, null for the ratio 0: criterion, at, slope, t, free, clusters; with d1, d2 and turn when asked for.

    A cluster of n rows weighs b = n / (1 + ratio n) by its mean, and 1 by what lies within it; written so, nothing cancels
    however large the ratio is.  With u = ratio b, b's first and second derivatives by ln(ratio) are -u b and b u (2u - 1),
    so the derivatives of the criterion need the same sums, weighted once and twice more.
    """
    orders = "sde" if bends else "s"
    weights = {"s": "w.b", "d": "-w.u * w.b", "e": "w.b * w.u * (2 * w.u - 1)"}
    terms = {f"{o}{m}": f"{weights[o]} * w.e.`{m}`" for o in orders for m in MOMENTS}
    terms |= {"n": "w.e._n * w.e.`1`", "clusters": "w.e.`1`", "logs": "log1p(q.ratio * w.e._n) * w.e.`1`", "wxx": "w.e.wxx", "wxy": "w.e.wxy", "wyy": "w.e.wyy"}
    terms |= {"dlogs": "w.u * w.e.`1`", "elogs": "w.u * (1 - w.u) * w.e.`1`"} if bends else {}
    weighed = "transform(_sizes, e -> named_struct('e', e, 'b', e._n / (1 + q.ratio * e._n), 'u', q.ratio * e._n / (1 + q.ratio * e._n)))"
    sums = f"aggregate({weighed}, {_struct(dict.fromkeys(terms, '0D'))}, (acc, w) -> {_struct({k: f'acc.{k} + {v}' for k, v in terms.items()})})"

    jet = lambda m: [f"(s.s{m} + s.w{m})" if o == "s" and len(m) == 2 else f"s.{o}{m}" for o in orders]
    parts = {v: _left_over(jet(v), jet(v[0]), jet(v[1]), jet("1")) for v in ("xx", "xy", "yy")}
    centred = _struct({"s": "s", "most": "s.sxx + s.wxx"} | {o + v: x for v, found in parts.items() for o, x in zip(orders, found)})
    left = _left_over(*([f"c.{o}{v}" for o in orders] for v in ("yy", "xy", "xy", "xx")))
    rest = _struct({"c": "c", "s": "c.s", "free": "c.s.n - 2"} | {f"{o}rss": x for o, x in zip(orders, left)})
    out = {
        "criterion": "r.free * ln(r.srss) + r.s.logs + ln(r.s.s1) + ln(r.c.sxx)", "at": "q.at", "slope": "r.c.sxy / r.c.sxx",
        "t": "r.c.sxy / r.c.sxx / sqrt(r.srss / r.free / r.c.sxx)", "free": "r.free", "clusters": "bigint(r.s.clusters)",
    }
    if bends:
        first = {"rss": "(r.drss / r.srss)", "a": "(r.s.d1 / r.s.s1)", "c": "(r.c.dxx / r.c.sxx)"}
        second = {k: f"({v} - {first[k]} * {first[k]})" for k, v in {"rss": "r.erss / r.srss", "a": "r.s.e1 / r.s.s1", "c": "r.c.exx / r.c.sxx"}.items()}
        out |= {
            "d1": f"r.free * {first['rss']} + r.s.dlogs + {first['a']} + {first['c']}",
            "d2": f"r.free * {second['rss']} + r.s.elogs + {second['a']} + {second['c']}",
            "turn": f"{first['rss']} - {first['c']}",
        }
    fitted = f"if(r.c.sxx > 1e-10 * r.c.most and r.srss > 0 and r.free > 0, {_struct(out)}, null)"
    start = _struct({"at": at, "ratio": f"coalesce(exp({at}), 0D)"})
    return _let("q", start, _let("s", sums, _let("c", centred, _let("r", rest, fitted))))


def _lowest(points: str) -> str:
    """SQL: the point where the criterion is lowest; a tiny ratio differs from none by rounding only, and then none is meant."""
    worth = "named_struct('worth', f.criterion + if(f.at is null, 0D, abs(f.criterion) * 1e-11D), 'at', f.at)"
    return f"array_min(transform(filter(transform({points}, p -> {_fit('p')}), f -> f is not null), f -> {worth})).at"


def random_intercept_by(
    df: DataFrame, keys: list[str], y: str, x: str, cluster: str, weight: str | None = None
) -> DataFrame:
    """Per group: y ~ x with a random intercept by cluster (REML); slope, t, degrees of freedom and p of x.

    Rows are reduced to sums by (group, cluster), and these to sums by group
    and cluster size.  The criterion is then a closed form of the variance
    ratio, and so are its derivatives, so the rest is arithmetic on one row per
    group: the lowest point is sought among 0 and all ratios a double can tell
    apart, once more round the best, and met by Newton steps.  Degrees of
    freedom are Satterthwaite's, from the derivatives; without variance between
    clusters they are rows - 2, in the limit without variance within clusters
    they are clusters - 2.  Equal rows give equal results to the last bit, in
    any order and however they are counted.
    """
    stats = stage(_cluster_sums(df, keys, y, x, cluster, weight), "cluster_sums")
    edge = f"{HIGHEST * DECADE!r}D"
    inner = f"(f.at < {edge} and f.d2 > 0)"
    grid = f"concat(array(cast(null as double)), transform(sequence({2 * LOWEST}, {2 * HIGHEST}), k -> k * {DECADE / 2!r}D))"
    near = f"transform(sequence({-FINE}, {FINE}), k -> v.mid + k * {DECADE / 2 / FINE!r}D)"
    newton = _let("f", _fit("at", bends=True), f"if({inner}, f.at + greatest(least(-f.d1 / f.d2, 0.1D), -0.1D), at)")
    met = f"aggregate(sequence(1, {STEPS}), z.mid, (at, i) -> {newton})"
    # one expression, each step named within it: as columns the steps would be written out in each other again and again
    last = _let("y", f"named_struct('at', {met})", _fit("y.at", bends=True))
    second = _let("z", f"named_struct('mid', if(v.mid < {edge}, {_lowest(near)}, v.mid))", last)
    whole = _let("v", f"named_struct('mid', {_lowest(grid)})", second)
    fits = stage(_by_size(stats, keys).select(*keys, F.expr(whole).alias("f")), "fits").filter("f is not null")  # a row per group
    freedom = F.expr(f"if(f.at is null, f.free, coalesce(if({inner}, 1 / (1 / f.free + f.turn * f.turn / f.d2), null), double(f.clusters - 2)))")
    found = fits.select(*keys, "f.slope", "f.t", "f.clusters", freedom.alias("df"))
    return found.select(
        *keys, F.col("slope").alias("estimate"), F.col("t").alias("t_value"), F.col("clusters").alias("n_clusters"), "df",
        F.when(F.col("clusters") > 2, two_sided_p(F.col("t"), F.col("df"))).alias("p_val"),
    )
