"""DuckDB SQL for every query that SQL can state."""

from __future__ import annotations

from demandtide.operators.descent import EPOCHS, FADE, FADE_SQUARES, FLOOR, RATE
from demandtide.operators.isolation import EULER, LEAST_DRAW, PRIME, SAMPLE, SEED, SURPLUS, TREES
from demandtide.operators.sarima import CANDIDATES, EDGE, ROUNDS, Order, strides
from demandtide.operators.smoothing import GRID
from demandtide.operators.stationarity import CRITICAL, LARGE_P, SMALL_P, TAU_MAX, TAU_MIN, TAU_STAR
from demandtide.operators.trend import KNOT_RANGE, KNOTS, PENALTIES, PENALTY, SEASONS


def _r(expr: str, name: str, places: int = 6) -> str:
    # Adding 0.0 turns a negative zero into zero.
    return f"round({expr}, {places}) + 0.0 AS {name}"


def _series(table: str = "events", ts: str = "ts", keys: str = "", unit: str = "hour", where: str = "true", common: bool = False) -> str:
    """CTE ``s(keys, ts, idx, n, y)``: counts on a spine without gaps."""
    k = f"{keys}, " if keys else ""
    using = f"USING ({k}ts)"
    part = f"PARTITION BY {keys}" if keys else ""
    whole = "CROSS JOIN (SELECT min(ts) AS a, max(ts) AS z FROM c)" if common else ""
    span = "w.a, w.z" if common else "min(ts) AS a, max(ts) AS z"
    ext = (
        f"ext AS (SELECT DISTINCT {k}a, z FROM c {whole})"
        if common
        else f"ext AS (SELECT {k}{span} FROM c {'GROUP BY ' + keys if keys else ''})"
    )
    return f"""
WITH c AS (
  SELECT {k}date_trunc('{unit}', {ts})::TIMESTAMP AS ts, count(*) AS c
  FROM {table} WHERE {where} GROUP BY ALL
), {ext},
spine AS (SELECT {k}unnest(generate_series(a, z, INTERVAL 1 {unit})) AS ts FROM ext),
s AS (
  SELECT {k}ts,
         row_number() OVER ({part} ORDER BY ts) - 1 AS idx,
         count(*) OVER ({part}) AS n,
         coalesce(c.c, 0)::DOUBLE AS y
  FROM spine LEFT JOIN c {using}
)"""


ALL = _series()
TYPED = _series(keys="event_type")

# Moving average and yesterday's value on the test rows, long.
PRED = TYPED + """,
w AS (
  SELECT *,
    avg(y) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS ma,
    lag(y, 24) OVER (PARTITION BY event_type ORDER BY idx) AS yd
  FROM s
),
p AS (
  SELECT event_type, 'moving_average' AS model, ts, idx, n, y AS actual, ma AS pred FROM w
  WHERE idx >= floor(n * 0.8::DOUBLE) AND ma IS NOT NULL
  UNION ALL
  SELECT event_type, 'same_hour_yesterday', ts, idx, n, y, yd FROM w
  WHERE idx >= floor(n * 0.8::DOUBLE) AND yd IS NOT NULL
)"""

METRICS = """
  avg(abs(actual - pred)) AS MAE,
  sqrt(avg((actual - pred) * (actual - pred))) AS RMSE,
  avg(CASE WHEN actual <> 0 THEN abs((actual - pred) / actual) END) * 100 AS MAPE,
  avg(CASE WHEN (abs(actual) + abs(pred)) / 2 <> 0 THEN abs(actual - pred) / ((abs(actual) + abs(pred)) / 2) END) * 100 AS SMAPE,
  1 - sum((actual - pred) * (actual - pred)) / (var_pop(actual) * count(*)) AS R2
"""

METRIC_SELECT = ", ".join(_r(m, m) for m in ("MAE", "RMSE", "MAPE", "SMAPE", "R2"))

RANKED = PRED + f""",
m AS (SELECT event_type, model, {METRICS} FROM p GROUP BY ALL),
mr AS (SELECT event_type, model, {METRIC_SELECT} FROM m)"""

WALK = TYPED + """,
w AS (
  SELECT *, avg(y) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS pred FROM s
),
ext2 AS (SELECT event_type, n, n // 6 AS size, n // 2 AS half FROM s WHERE idx = 0),
f AS (
  SELECT event_type, (i + 1)::INTEGER AS fold, half + i * size AS train_end, half + (i + 1) * size AS test_end
  FROM ext2, range(0, 5) r(i) WHERE half + (i + 1) * size <= n AND size > 0
),
sc AS (
  SELECT w.event_type, fold, sqrt(avg((y - pred) * (y - pred))) AS rmse
  FROM w JOIN f ON w.event_type = f.event_type AND w.idx >= train_end AND w.idx < test_end
  GROUP BY ALL
)"""


def _profile(series: str, keys: str) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return series + f""",
z AS (SELECT *, (y - avg(y) OVER ({part})) / stddev_samp(y) OVER ({part}) AS z FROM s),
e AS (
  SELECT *, z - avg(z) OVER (PARTITION BY {k}isodow(ts), hour(ts)) AS d FROM z
),
pr AS (
  SELECT {k}'profile' AS method, ts, idx, n, y,
    CASE WHEN idx >= 23 THEN avg(d * d) OVER ({part} ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) ELSE 0.0::DOUBLE END AS score
  FROM e
)"""


PROFILE = _profile(TYPED, "event_type")

FLAGGED = PROFILE + """,
t AS (SELECT event_type, quantile_cont(score, 0.95) AS threshold FROM pr WHERE idx >= 23 GROUP BY 1),
fl AS (SELECT pr.*, threshold, idx >= 23 AND score > threshold AS is_anomaly FROM pr JOIN t USING (event_type))"""

TWO = _profile(ALL, "") + """,
m0 AS (SELECT *, avg(y) OVER (ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS pred FROM s),
m1 AS (SELECT *, coalesce(abs(y - pred), 0.0::DOUBLE) AS err FROM m0),
tw AS (
  SELECT method, ts, idx, n, y, score FROM pr
  UNION ALL
  SELECT 'moving_average', ts, idx, n, y,
    CASE WHEN idx >= 23 THEN avg(err) OVER (ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) ELSE 0.0::DOUBLE END
  FROM m1
)"""


def _box(group: str) -> str:
    names = group.replace("weekday", "(isodow(ts) - 1)::INTEGER AS weekday, dayname(ts) AS day_name").replace(
        "hour", "hour(ts)::INTEGER AS hour"
    )
    by = "weekday, day_name" if group == "weekday" else "hour"
    return ALL + f""",
g AS (SELECT {names}, y FROM s),
q AS (
  SELECT {by}, count(*) AS n, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS med, quantile_cont(y, 0.75) AS q3
  FROM g GROUP BY ALL
)
SELECT {by}, n, q1, med, q3,
  min(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1)) AS whisker_lo,
  max(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS n_out
FROM g JOIN q USING ({by}) GROUP BY ALL"""


def _smoothing(weights: str, rows: str) -> str:
    """CTE ``hw``: the recursion step by step, season as a list with the oldest term first."""
    return TYPED + f""",
tr AS (SELECT * FROM s WHERE {rows}),
g(a, b, c) AS (VALUES {weights}),
first AS (
  SELECT event_type, avg(y) FILTER (WHERE idx < 24) AS l0,
    (avg(y) FILTER (WHERE idx >= 24 AND idx < 48) - avg(y) FILTER (WHERE idx < 24)) / 24 AS b0,
    list(y ORDER BY idx) FILTER (WHERE idx < 24) AS ys
  FROM tr GROUP BY 1
),
hw AS (
  SELECT event_type, a, b, c, -1::BIGINT AS idx, l0 AS level, b0 AS trend, list_transform(ys, lambda v: v - l0) AS season,
    NULL::DOUBLE AS y, NULL::DOUBLE AS pred
  FROM first CROSS JOIN g
  UNION ALL
  SELECT event_type, a, b, c, idx, nl, b * (nl - level) + (1 - b) * trend,
    list_append(season[2:24], c * (y - nl) + (1 - c) * season[1]), y, pred
  FROM (
    SELECT hw.event_type, a, b, c, tr.idx, level, trend, season, tr.y, level + trend + season[1] AS pred,
      a * (tr.y - season[1]) + (1 - a) * (level + trend) AS nl
    FROM hw JOIN tr ON tr.event_type = hw.event_type AND tr.idx = hw.idx + 1
  )
)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH c AS", "WITH RECURSIVE c AS", 1)


def _matrix(x: str, out: str, extra: str = "0") -> str:
    """CTE ``out(g, m)``: sums of products of the long design ``x(g, t, i, v)`` as a list of rows."""
    return f""",
{out}_p AS (SELECT a.g, a.i, b.i AS j, sum(a.v * b.v) AS v FROM {x} a JOIN {x} b ON a.g = b.g AND a.t = b.t GROUP BY ALL),
{out}_r AS (SELECT g, i, list(v + {extra} ORDER BY j) AS r FROM {out}_p GROUP BY ALL),
{out} AS (SELECT g, list(r ORDER BY i) AS m FROM {out}_r GROUP BY ALL)"""


def _eliminate(src: str, out: str, steps: str) -> str:
    """CTE ``out(g, k, m)``: Gauss-Jordan elimination of the first k columns, step by step."""
    return f""",
{out} AS (
  SELECT g, 0::BIGINT AS k, m FROM {src}
  UNION ALL
  SELECT g, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / r[k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) END)
  FROM {out} WHERE k < {steps}
)"""


def _poly(coef: tuple[float, ...]) -> str:
    return " + ".join(f"({c}::DOUBLE) * pow(tau, {i})" for i, c in enumerate(coef))


def _surface(name: str) -> str:
    return " + ".join(f"({c}::DOUBLE) / pow(nobs, {i})" for i, c in enumerate(CRITICAL[name]))


ADF = (
    TYPED
    + """,
d0 AS (SELECT event_type AS g, idx, n, y - lag(y) OVER w AS dy, lag(y) OVER w AS yl FROM s WINDOW w AS (PARTITION BY event_type ORDER BY idx)),
top AS (SELECT event_type AS g, n, least(ceil(12 * pow(n / 100.0::DOUBLE, 0.25::DOUBLE)), n // 2 - 2)::BIGINT AS lags FROM s WHERE idx = 0),
x1 AS (
  SELECT g, idx AS t, 1 AS i, 1.0::DOUBLE AS v FROM d0 JOIN top USING (g) WHERE idx > lags
  UNION ALL SELECT g, idx, 2, yl FROM d0 JOIN top USING (g) WHERE idx > lags
  UNION ALL SELECT a.g, a.idx, 2 + a.idx - b.idx, b.dy FROM d0 a JOIN top ON a.g = top.g
    JOIN d0 b ON a.g = b.g AND b.idx BETWEEN a.idx - lags AND a.idx - 1 WHERE a.idx > lags
  UNION ALL SELECT g, idx, lags + 3, dy FROM d0 JOIN top USING (g) WHERE idx > lags
)"""
    + _matrix("x1", "m1")
    + _eliminate("m1", "e1", "len(m) - 1")
    + """,
aic AS (
  SELECT e1.g, k - 2 AS lag, (n - 1 - lags) * (ln(2 * pi()) + ln(m[len(m)][len(m)] / (n - 1 - lags)) + 1) + 2 * k AS aic
  FROM e1 JOIN top ON top.g = e1.g WHERE k >= 2
),
used AS (SELECT g, lag FROM aic QUALIFY row_number() OVER (PARTITION BY g ORDER BY aic, lag) = 1),
x2 AS (
  SELECT g, idx AS t, 1 AS i, 1.0::DOUBLE AS v FROM d0 JOIN used USING (g) WHERE idx > lag
  UNION ALL SELECT a.g, a.idx, 1 + a.idx - b.idx, b.dy FROM d0 a JOIN used ON a.g = used.g
    JOIN d0 b ON a.g = b.g AND b.idx BETWEEN a.idx - lag AND a.idx - 1 WHERE a.idx > lag
  UNION ALL SELECT g, idx, lag + 2, yl FROM d0 JOIN used USING (g) WHERE idx > lag
  UNION ALL SELECT g, idx, lag + 3, dy FROM d0 JOIN used USING (g) WHERE idx > lag
)"""
    + _matrix("x2", "m2")
    + _eliminate("m2", "e2", "len(m) - 2")
    + """,
fit AS (
  SELECT e2.g, lag, n - 1 - lag AS nobs, m[lag + 2][lag + 2] AS p, m[lag + 2][lag + 3] AS r, m[lag + 3][lag + 3] AS s
  FROM e2 JOIN used ON used.g = e2.g AND k = lag + 1 JOIN top ON top.g = e2.g
),
tau AS (SELECT g, lag, nobs, (r / p) / sqrt((s - r * r / p) / (nobs - lag - 2) / p) AS tau FROM fit),
z AS (SELECT *, CASE WHEN tau <= """
    + f"{TAU_STAR}::DOUBLE THEN {_poly(SMALL_P)} ELSE {_poly(LARGE_P)} END AS z FROM tau)"
    + """,
area AS (  -- Simpson's rule for the normal curve between 0 and z
  SELECT g, z / 2000 / 3 / sqrt(2 * pi()) * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-pow(z * i / 2000, 2) / 2)) AS area
  FROM z, range(0, 2001) q(i) GROUP BY g, z
),
pv AS (SELECT z.*, """
    + f"CASE WHEN tau > {TAU_MAX} THEN 1 WHEN tau < {TAU_MIN} THEN 0 ELSE 0.5::DOUBLE + area END AS pvalue FROM z JOIN area USING (g))"
)

# Two waves (sine, cosine) per term, then the hinges; the value is the last column.
_WAVES = ", ".join(f"{f}(2 * pi() * idx * {k} / {p}.0::DOUBLE)" for p, top in SEASONS for k in range(1, top + 1) for f in ("sin", "cos"))
_HINGES = ", ".join(f"greatest(u - {KNOT_RANGE * i / KNOTS}::DOUBLE, 0)" for i in range(1, KNOTS + 1))
_PLAIN = 2 + 2 * sum(top for _, top in SEASONS)
_LAST = _PLAIN + KNOTS + 1

TREND = (
    TYPED
    + f""",
b AS (SELECT *, floor(n * 0.8::DOUBLE)::BIGINT AS cut FROM s),
u AS (SELECT *, idx / (cut - 1)::DOUBLE AS u FROM b),
long AS (
  SELECT event_type AS g, idx AS t, cut, unnest(range(1, {_LAST + 1})) AS i, unnest([1.0::DOUBLE, u, {_WAVES}, {_HINGES}, y]) AS v FROM u
),
x AS (SELECT g, t, i, v FROM long WHERE t < cut)"""
    + _matrix("x", "m0", f"CASE WHEN i = j AND i > {_PLAIN} AND i < {_LAST} THEN {PENALTY}::DOUBLE ELSE 0 END")
    + _eliminate("m0", "el", "len(m) - 1")
    + f""",
pr AS (
  SELECT long.g, t, sum(v * m[i][{_LAST}]) AS pred FROM long JOIN el ON el.g = long.g AND el.k = {_LAST - 1}
  WHERE t >= cut AND i < {_LAST} GROUP BY ALL
)"""
)


def _lag_regression(train: str, part: str) -> str:
    """CTEs for one least-squares model over all series: ``z`` from 24 lags; ``lr(event_type, idx, z, hat)``."""
    lags = ", ".join(f"lag(z, {k}) OVER w" for k in range(24, 0, -1))
    return (
        TYPED
        + f""",
sp AS (SELECT *, idx < floor(n * 0.8::DOUBLE) AS train FROM s),
st AS (SELECT event_type, avg(y) AS mean, stddev_samp(y) AS std FROM sp WHERE {train} GROUP BY 1),
z AS (SELECT sp.*, (y - mean) / std AS z, mean, std FROM sp JOIN st USING (event_type)),
wide AS (
  SELECT event_type, idx, ts, y, train, mean, std, z, [1.0::DOUBLE, {lags}, z] AS x FROM z
  WINDOW w AS (PARTITION BY event_type{part} ORDER BY idx)
),
full_ AS (SELECT *, row_number() OVER (ORDER BY event_type, idx) AS t FROM wide WHERE x[2] IS NOT NULL),
x AS (SELECT 1 AS g, t, unnest(range(1, 27)) AS i, unnest(x) AS v FROM full_ WHERE {train})"""
        + _matrix("x", "m0")
        + _eliminate("m0", "el", "len(m) - 1")
        + """,
beta AS (SELECT list_transform(m, lambda r: r[26]) AS b FROM el WHERE k = 25),
lr AS (SELECT event_type, idx, ts, y, train, mean, std, z, list_dot_product(x[1:25], b[1:25]) AS hat FROM full_, beta)"""
    )


def _adam() -> str:
    """CTE ``ep(k, b)``: weights after epoch k, from the sums ``ga`` of the training and ``gb`` of the test windows."""
    zeros = "list_transform(range(0, 25), lambda v: 0.0::DOUBLE)"
    return (
        _lag_regression("train", ", train")
        + """,
xb AS (SELECT 1 AS g, t, unnest(range(1, 27)) AS i, unnest(x) AS v FROM full_ WHERE NOT train)"""
        + _matrix("x", "ga")
        + _matrix("xb", "gb")
        + f""",
ep AS (
  SELECT 0 AS k, {zeros} AS b, {zeros} AS speed, {zeros} AS square
  UNION ALL
  SELECT k + 1, list_transform(b, lambda w, i: w - {RATE} * (u[i] / (1 - pow({FADE}::DOUBLE, k + 1))) / (sqrt(q[i] / (1 - pow({FADE_SQUARES}::DOUBLE, k + 1))) + {FLOOR})), u, q
  FROM (
    SELECT k, b, list_transform(speed, lambda w, i: {FADE} * w + {1 - FADE!r}::DOUBLE * gr[i]) AS u,
      list_transform(square, lambda w, i: {FADE_SQUARES} * w + {1 - FADE_SQUARES!r}::DOUBLE * gr[i] * gr[i]) AS q
    FROM (SELECT ep.*, list_transform(m[1:25], lambda r: 2 / m[1][1] * (list_dot_product(r[1:25], b) - r[26])) AS gr FROM ep, ga WHERE k < {EPOCHS})
  )
)"""
    )


def _epoch_loss(sums: str, split: str) -> str:
    quadratic = "list_sum(list_transform(b, lambda w, i: w * list_dot_product(m[i][1:25], b)))"
    cross = "list_sum(list_transform(b, lambda w, i: w * m[i][26]))"
    return f"SELECT 'lag_adam' AS model, '{split}' AS split, k AS iteration, {_r(f'(m[26][26] - 2 * {cross} + {quadratic}) / m[1][1]', 'loss')} FROM ep, {sums} WHERE k > 0"


SEQUENCE = _lag_regression("true", "") + """,
er AS (SELECT s.event_type, s.ts, s.idx, s.y, (z - hat) * (z - hat) AS err FROM s LEFT JOIN lr ON lr.event_type = s.event_type AND lr.idx = s.idx),
pr AS (
  SELECT event_type, ts, idx, y,
    CASE WHEN idx >= 23 THEN coalesce(avg(err) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 0) ELSE 0 END AS score
  FROM er
),
t AS (SELECT event_type, quantile_cont(score, 0.95) AS threshold FROM pr WHERE idx >= 23 GROUP BY 1)"""

_PAIRS = ", ".join(f"[{p}, {q}]" for p in range(1, 25) for q in range(p + 1, 25))
_SWEEPS = 9
_TURN_COLUMNS = "lambda r: list_transform(r, lambda x, j: CASE WHEN j = p THEN c * r[p] - s * r[q] WHEN j = q THEN s * r[p] + c * r[q] ELSE x END)"

# Jacobi rotations of the 24 by 24 spread of the windows, the eight main axes, what they leave.
PATTERNS = (
    TYPED
    + f""",
z AS (SELECT *, (y - avg(y) OVER (PARTITION BY event_type)) / stddev_samp(y) OVER (PARTITION BY event_type) AS z FROM s),
wide AS (
  SELECT event_type AS g, idx, [{', '.join(f'lag(z, {k}) OVER w' for k in range(23, -1, -1))}] AS x FROM z WINDOW w AS (PARTITION BY event_type ORDER BY idx)
),
raw AS (SELECT g, idx AS t, unnest(range(1, 25)) AS i, unnest(x) AS v FROM wide WHERE idx >= 23),
x AS (SELECT g, t, i, v - avg(v) OVER (PARTITION BY g, i) AS v FROM raw)"""
    + _matrix("x", "m0")
    + f""",
pairs AS (SELECT [{_PAIRS}] AS pq),
ja AS (
  SELECT g, 0::BIGINT AS k, m, list_transform(m, lambda r, i: list_transform(r, lambda x, j: CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS axes FROM m0
  UNION ALL
  SELECT g, k + 1,
    list_transform(mc, lambda r, i: CASE WHEN i = p THEN list_transform(r, lambda x, j: c * mc[p][j] - s * mc[q][j])
      WHEN i = q THEN list_transform(r, lambda x, j: s * mc[p][j] + c * mc[q][j]) ELSE r END),
    axes
  FROM (
    SELECT g, k, p, q, c, s, list_transform(m, {_TURN_COLUMNS}) AS mc, list_transform(axes, {_TURN_COLUMNS}) AS axes
    FROM (
      SELECT *, 1 / sqrt(tn * tn + 1) AS c, tn / sqrt(tn * tn + 1) AS s
      FROM (
        SELECT *, CASE WHEN abs(m[p][q]) < 1e-200 THEN 0 ELSE (CASE WHEN th < 0 THEN -1 ELSE 1 END) / (abs(th) + sqrt(th * th + 1)) END AS tn
        FROM (
          SELECT *, CASE WHEN abs(m[p][q]) < 1e-200 THEN 0 ELSE (m[q][q] - m[p][p]) / (2 * m[p][q]) END AS th
          FROM (SELECT g, k, m, axes, pq[(k % 276) + 1][1] AS p, pq[(k % 276) + 1][2] AS q FROM ja, pairs WHERE k < 276 * {_SWEEPS})
        )
      )
    )
  )
),
ax AS (SELECT g, m, axes, unnest(range(1, 25)) AS a FROM ja WHERE k = 276 * {_SWEEPS}),
best AS (SELECT * FROM ax QUALIFY row_number() OVER (PARTITION BY g ORDER BY m[a][a] DESC) <= 8),
pj AS (SELECT x.g, t, a, sum(v * axes[i][a]) AS u FROM x JOIN best ON best.g = x.g GROUP BY ALL),
sq AS (SELECT g, t, sum(v * v) AS whole FROM x GROUP BY ALL),
er AS (SELECT sq.g, sq.t, (any_value(whole) - sum(u * u)) / 24 AS e FROM sq JOIN pj ON pj.g = sq.g AND pj.t = sq.t GROUP BY ALL),
pr AS (SELECT event_type, ts, idx, y, coalesce(e, 0) AS score FROM s LEFT JOIN er ON er.g = s.event_type AND er.t = s.idx),
t AS (SELECT event_type, quantile_cont(score, 0.95) AS threshold FROM pr WHERE idx >= 23 GROUP BY 1)"""
)

_STRIDES = ", ".join(f"{float(v)!r}::DOUBLE" for v in strides(6))
# Weights of lags 1, 2, 24, 25, 26 from the six search numbers ``u``.
_WEIGHTS = """[u[1] * (1 - u[2]), u[2], u[5], -u[1] * (1 - u[2]) * u[5], -u[2] * u[5]] AS a,
  [-u[3] * (1 - u[4]), -u[4], u[6], -u[3] * (1 - u[4]) * u[6], -u[4] * u[6]] AS m"""
_ZEROS = "list_transform(range(0, 26), lambda v: 0.0::DOUBLE)"


def _round(turn: int) -> str:
    """CTEs of one search round: candidates around ``c{turn}``, their errors step by step, the next centre."""
    return f""",
t{turn} AS (
  SELECT g, i, CASE WHEN i = 0 THEN ce ELSE list_transform([{_STRIDES}], lambda v, d: greatest(-{EDGE}::DOUBLE, least({EDGE}::DOUBLE,
    ce[d] + {EDGE * 0.5**turn!r}::DOUBLE * (2 * ((0.5::DOUBLE + (i + {turn * CANDIDATES}) * v) % 1) - 1)))) END AS u
  FROM c{turn}, range(0, {CANDIDATES}) r(i)
),
w{turn} AS (SELECT g, i, u, {_WEIGHTS} FROM t{turn}),
e{turn} AS (
  SELECT g, i, u, a, m, 24::BIGINT AS idx, {_ZEROS} AS e, 0.0::DOUBLE AS sse FROM w{turn}
  UNION ALL
  SELECT g, i, u, a, m, idx, list_append(e[2:26], x), sse + CASE WHEN idx >= 51 THEN x * x ELSE 0 END
  FROM (
    SELECT e.g, i, u, a, m, d.idx, e, sse, w0 - (a[1] * w1 + a[2] * w2 + a[3] * w24 + a[4] * w25 + a[5] * w26)
      - (m[1] * e[26] + m[2] * e[25] + m[3] * e[3] + m[4] * e[2] + m[5] * e[1]) AS x
    FROM e{turn} e JOIN d ON d.g = e.g AND d.idx = e.idx + 1
  )
),
b{turn} AS (
  SELECT e.* FROM e{turn} e JOIN ends ON ends.g = e.g AND ends.cut - 1 = e.idx
  QUALIFY row_number() OVER (PARTITION BY e.g ORDER BY sse, i) = 1
),
c{turn + 1} AS (SELECT g, u AS ce FROM b{turn})"""


_TOP = ROUNDS - 1
SARIMA = (
    TYPED
    + f""",
ends AS (SELECT event_type AS g, n, floor(n * 0.8::DOUBLE)::BIGINT AS cut FROM s WHERE idx = 0),
dw AS (
  SELECT event_type AS g, idx, y, y - lag(y) OVER w - lag(y, 24) OVER w + lag(y, 25) OVER w AS wv FROM s WINDOW w AS (PARTITION BY event_type ORDER BY idx)
),
d AS (
  SELECT g, idx, wv AS w0, {', '.join(f'coalesce(lag(wv, {k}) OVER w, 0) AS w{k}' for k in (1, 2, 24, 25, 26))}
  FROM dw JOIN ends USING (g) WHERE idx < cut WINDOW w AS (PARTITION BY g ORDER BY idx)
),
c0 AS (SELECT g, list_transform(range(0, 6), lambda v: 0.0::DOUBLE) AS ce FROM ends)"""
    + "".join(_round(turn) for turn in range(ROUNDS))
    + f""",
past AS (
  SELECT dw.g, list(wv ORDER BY idx) FILTER (WHERE idx >= cut - 26) AS wl, list(y ORDER BY idx) FILTER (WHERE idx >= cut - 25) AS yl
  FROM dw JOIN ends USING (g) WHERE idx < cut GROUP BY 1
),
fc AS (
  SELECT b.g, cut - 1 AS idx, n, a, m, e, wl, yl, NULL::DOUBLE AS pred FROM b{_TOP} b JOIN past ON past.g = b.g JOIN ends ON ends.g = b.g
  UNION ALL
  SELECT g, idx + 1, n, a, m, list_append(e[2:26], 0.0::DOUBLE), list_append(wl[2:26], x), list_append(yl[2:25], lv), lv
  FROM (
    SELECT *, yl[25] + x + yl[2] - yl[1] AS lv
    FROM (
      SELECT *, a[1] * wl[26] + a[2] * wl[25] + a[3] * wl[3] + a[4] * wl[2] + a[5] * wl[1]
        + m[1] * e[26] + m[2] * e[25] + m[3] * e[3] + m[4] * e[2] + m[5] * e[1] AS x
      FROM fc WHERE idx < n - 1
    )
  )
),
ic AS (SELECT b.g, cut - 51 AS nobs, (cut - 51) * (ln(2 * pi()) + ln(sse / (cut - 51)) + 1) AS fit FROM b{_TOP} b JOIN ends ON ends.g = b.g)"""
)



def _weights(numbers: list[str]) -> list[str]:
    """Weights of lags 1, 2, .. from partial autocorrelations, as expressions."""
    out: list[str] = []
    for last in numbers:
        out = [f"({w} - {last} * {back})" for w, back in zip(out, reversed(out))] + [last]
    return out


def _arima(order: Order, value: str = "y") -> str:
    """CTEs ``fc`` (forecasts) and ``ic`` (information) of one order over the series ``s`` without keys."""
    o, depth, keep = order, order.memory, max(order.lost, 1)
    u = [f"u[{i + 1}]" for i in range(o.dims)]
    cuts = [0, o.p, o.p + o.q, o.p + o.q + o.seasonal_p, o.dims]
    phi, the, sphi, sthe = (_weights(u[a:b]) for a, b in zip(cuts, cuts[1:]))
    the, sthe = ([w if len(x) == 1 else f"(-{w})" for w in x] for x in (the, sthe))
    a = phi + [e for own in sphi for e in (own, *[f"(-{x} * {own})" for x in phi])]
    m = the + [e for own in sthe for e in (own, *[f"({x} * {own})" for x in the])]
    steps = ", ".join(f"{float(v)!r}::DOUBLE" for v in strides(o.dims))
    error = " - ".join(["w0", *[f"a[{i + 1}] * w{lag}" for i, lag in enumerate(o.ar_lags)], *[f"m[{i + 1}] * e[{depth + 1 - lag}]" for i, lag in enumerate(o.ma_lags)]])
    ahead = " + ".join([*[f"a[{i + 1}] * wl[{depth + 1 - lag}]" for i, lag in enumerate(o.ar_lags)], *[f"m[{i + 1}] * e[{depth + 1 - lag}]" for i, lag in enumerate(o.ma_lags)]])
    level = " + ".join(["x", *[f"{c!r}::DOUBLE * yl[{keep + 1 - lag}]" for lag, c in o.undo.items()]])
    differenced = " - ".join(["y", *[f"{c!r}::DOUBLE * lag(y, {lag}) OVER w" for lag, c in o.undo.items()]])
    lags = "".join(f", coalesce(lag(wv, {k}) OVER w, 0) AS w{k}" for k in sorted(set(o.ar_lags)))
    out = f""",
ends AS (SELECT n, floor(n * 0.8::DOUBLE)::BIGINT AS cut FROM s WHERE idx = 0),
dw AS (SELECT idx, y, {differenced} AS wv FROM (SELECT idx, {value} AS y FROM s) WINDOW w AS (ORDER BY idx)),
d AS (SELECT idx, wv AS w0{lags} FROM dw, ends WHERE idx < cut WINDOW w AS (ORDER BY idx)),
c0 AS (SELECT list_transform(range(0, {o.dims}), lambda v: 0.0::DOUBLE) AS ce)"""
    for turn in range(ROUNDS):
        out += f""",
t{turn} AS (
  SELECT i, CASE WHEN i = 0 THEN ce ELSE list_transform([{steps}], lambda v, d: greatest(-{EDGE}::DOUBLE, least({EDGE}::DOUBLE,
    ce[d] + {EDGE * 0.5**turn!r}::DOUBLE * (2 * ((0.5::DOUBLE + (i + {turn * CANDIDATES}) * v) % 1) - 1)))) END AS u
  FROM c{turn}, range(0, {CANDIDATES}) r(i)
),
e{turn} AS (
  SELECT i, u, [{", ".join(a)}]::DOUBLE[] AS a, [{", ".join(m)}]::DOUBLE[] AS m, {o.lost - 1}::BIGINT AS idx,
    list_transform(range(0, {depth}), lambda v: 0.0::DOUBLE) AS e, 0.0::DOUBLE AS sse FROM t{turn}
  UNION ALL
  SELECT i, u, a, m, idx, list_append(e[2:{depth}], x), sse + CASE WHEN idx >= {o.margin} THEN x * x ELSE 0 END
  FROM (SELECT i, u, a, m, d.idx, e, sse, {error} AS x FROM e{turn} e JOIN d ON d.idx = e.idx + 1)
),
b{turn} AS (SELECT e.* FROM e{turn} e JOIN ends ON ends.cut - 1 = e.idx QUALIFY row_number() OVER (ORDER BY sse, i) = 1),
c{turn + 1} AS (SELECT u AS ce FROM b{turn})"""
    return out + f""",
past AS (SELECT list(wv ORDER BY idx) FILTER (WHERE idx >= cut - {depth}) AS wl, list(y ORDER BY idx) FILTER (WHERE idx >= cut - {keep}) AS yl FROM dw, ends WHERE idx < cut),
fc AS (
  SELECT cut - 1 AS idx, n, a, m, e, wl, yl, NULL::DOUBLE AS pred FROM b{_TOP}, past, ends
  UNION ALL
  SELECT idx + 1, n, a, m, list_append(e[2:{depth}], 0.0::DOUBLE), list_append(wl[2:{depth}], x), list_append(yl[2:{keep}], lv), lv
  FROM (SELECT *, {level} AS lv FROM (SELECT *, {ahead} AS x FROM fc WHERE idx < n - 1))
),
ic AS (SELECT cut - {o.margin} AS nobs, (cut - {o.margin}) * (ln(2 * pi()) + ln(sse / (cut - {o.margin})) + 1) AS fit FROM b{_TOP}, ends)"""


def _arima_rows(name: str, order: Order) -> str:
    """One order's forecast rows, as a whole statement."""
    return _recursive(ALL + _arima(order)) + f""" SELECT '{name}' AS model, ts, y, {_r('pred', 'pred')}, {_r(f'fit + {2 * (order.dims + 1)}', 'aic')}, {_r(f'fit + ln(nobs) * {order.dims + 1}', 'bic')}
FROM s JOIN fc ON fc.idx = s.idx AND pred IS NOT NULL, ic"""


def _draw(*parts: str) -> str:
    """The forest's draw from whole numbers, as one expression."""
    h = f"{SEED}::BIGINT"
    for part in parts:
        h = f"(({h} * 48271 + {part}) % {PRIME})"
    square = f"({h} * {h} % {PRIME})"
    return f"((({square} * {square} % {PRIME} * {h} + 16807) % {PRIME}) / {PRIME}.0::DOUBLE)"


_DEPTH = 8


def _level(k: int) -> str:
    """CTEs of one level of all trees: the cut of every node that parts, then the rows moved down."""
    return f""",
f{k} AS MATERIALIZED (
  SELECT tree, node, i, min(x[i]) AS lo, max(x[i]) AS hi FROM a{k}, range(1, 25) r(i) WHERE node >= {2**k} GROUP BY ALL HAVING min(x[i]) < max(x[i])
),
l{k} AS MATERIALIZED (SELECT tree, node, list(i ORDER BY i) AS fs FROM f{k} GROUP BY ALL),
p{k} AS MATERIALIZED (SELECT tree, node, fs[1 + floor({_draw('tree', 'node', '1')} * len(fs))::BIGINT] AS f, {_draw('tree', 'node', '2')} AS u FROM l{k}),
s{k} AS MATERIALIZED (
  SELECT p.tree, p.node, f, CASE WHEN lo + u * (hi - lo) > lo THEN lo + u * (hi - lo) ELSE hi END AS cut
  FROM p{k} p JOIN f{k} ON f{k}.tree = p.tree AND f{k}.node = p.node AND f{k}.i = f
),
a{k + 1} AS MATERIALIZED (
  SELECT a.tree, x, CASE WHEN cut IS NULL THEN a.node ELSE 2 * a.node + (x[f] >= cut)::INTEGER END AS node
  FROM a{k} a LEFT JOIN s{k} s ON s.tree = a.tree AND s.node = a.node
),
v{k + 1} AS MATERIALIZED (
  SELECT v.tree, idx, x, CASE WHEN cut IS NULL THEN v.node ELSE 2 * v.node + (x[f] >= cut)::INTEGER END AS node
  FROM v{k} v LEFT JOIN s{k} s ON s.tree = v.tree AND s.node = v.node
)"""


def _average_path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + {EULER}::DOUBLE) - 2 * ({n} - 1) / {n}::DOUBLE END"


def _gap(turn: str) -> str:
    """Trees passed over before the next one that takes a window."""
    return f"CASE WHEN missed IS NULL THEN 0 ELSE floor(ln(greatest({_draw(turn, '0', 'idx', '1')}, {LEAST_DRAW}::DOUBLE)) / missed)::BIGINT END"


FOREST = (
    ALL
    + f""",
win AS MATERIALIZED (
  SELECT * FROM (SELECT idx, list(y) OVER (ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS x FROM s) WHERE idx >= 23
),
size AS (SELECT count(*) AS w FROM win),
odds AS (SELECT CASE WHEN {SURPLUS}::DOUBLE * {SAMPLE} < w THEN ln(1 - {SURPLUS}::DOUBLE * {SAMPLE} / w) END AS missed FROM size),
drawn AS (
  SELECT idx, 0::BIGINT AS k, {_gap('0')} AS tree FROM win, odds
  UNION ALL
  SELECT idx, k + 1, tree + 1 + {_gap('(k + 1)')} FROM drawn, odds WHERE tree < {TREES}
),
a0 AS MATERIALIZED (
  SELECT tree::INTEGER AS tree, x, 1 AS node FROM drawn JOIN win USING (idx) WHERE tree < {TREES}
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {_draw('tree', '0', 'idx', '2')}, idx) <= {SAMPLE}
),
v0 AS MATERIALIZED (SELECT tree, idx, x, 1 AS node FROM win, range(0, {TREES}) r(tree))"""
    + "".join(_level(k) for k in range(_DEPTH))
    + f""",
leaf AS (SELECT tree, node, floor(log2(node)) + {_average_path('count(*)')} AS path FROM a{_DEPTH} GROUP BY tree, node),
sc AS (
  SELECT idx, pow(2, -avg(path) / (SELECT {_average_path(f'least({SAMPLE}, w)')} FROM size)) AS score
  FROM v{_DEPTH} v JOIN leaf ON leaf.tree = v.tree AND leaf.node = v.node GROUP BY 1
),
pr AS (SELECT ts, s.idx, y, coalesce(score, 0) AS score FROM s LEFT JOIN sc ON sc.idx = s.idx),
t AS (SELECT quantile_cont(score, 0.95) AS threshold FROM pr WHERE idx >= 23)"""
)

GRID_VALUES = ", ".join("(" + ", ".join(f"{v}::DOUBLE" for v in w) + ")" for w in GRID)

HOLT = _smoothing(GRID_VALUES, "idx < floor(n * 0.8::DOUBLE)") + """,
e AS (SELECT event_type, a, b, c, sum((y - pred) * (y - pred)) AS sse, max(idx) AS last FROM hw WHERE idx >= 0 GROUP BY ALL),
best AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY sse) = 1),
f AS (SELECT best.*, level, trend, season FROM best JOIN hw ON hw.event_type = best.event_type AND hw.a = best.a AND hw.b = best.b AND hw.c = best.c AND hw.idx = best.last)"""

# A ridge per fold and penalty on the training part, the penalty of the least mean error, and its ridge on all of that part.
_BENDS = f"list_transform(m, lambda r, i: list_transform(r, lambda v, j: v + CASE WHEN i = j AND i > {_PLAIN} AND i < {_LAST} THEN penalty ELSE 0 END))"
TUNED = (
    TYPED
    + f""",
b AS (SELECT *, floor(n * 0.8::DOUBLE)::BIGINT AS cut FROM s),
u AS (SELECT *, idx / (cut - 1)::DOUBLE AS u FROM b),
long AS (SELECT event_type AS e, idx AS t, cut, unnest(range(1, {_LAST + 1})) AS i, unnest([1.0::DOUBLE, u, {_WAVES}, {_HINGES}, y]) AS v FROM u),
fo AS (
  SELECT event_type AS e, fold, cut // 2 + (fold - 1) * (cut // 6) AS train_end, cut // 2 + fold * (cut // 6) AS test_end
  FROM b, range(1, 6) r(fold) WHERE idx = 0 AND cut // 2 + fold * (cut // 6) <= cut
),
x AS (SELECT long.e || '/' || fold AS g, t, i, v FROM long JOIN fo ON fo.e = long.e AND t < train_end)"""
    + _matrix("x", "mm")
    + f""",
pens AS (SELECT unnest(range(0, {len(PENALTIES)})) AS place, unnest([{", ".join(f"{v}::DOUBLE" for v in PENALTIES)}]) AS penalty),
m0 AS (SELECT g || '/' || place AS g, {_BENDS} AS m FROM mm, pens)"""
    + _eliminate("m0", "el", "len(m) - 1")
    + f""",
hat AS (
  SELECT fo.e, fold, place, t, sum(CASE WHEN i < {_LAST} THEN v * m[i][{_LAST}] ELSE 0 END) AS pred, sum(CASE WHEN i = {_LAST} THEN v END) AS y
  FROM long JOIN fo ON fo.e = long.e AND t >= train_end AND t < test_end, pens JOIN el ON el.k = {_LAST - 1}
  WHERE el.g = fo.e || '/' || fold || '/' || place GROUP BY ALL
),
er AS (SELECT e, fold, place, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM hat GROUP BY ALL),
best AS (SELECT e, place, avg(rmse) AS mean_rmse FROM er GROUP BY e, place QUALIFY row_number() OVER (PARTITION BY e ORDER BY avg(rmse), place) = 1),
xf AS (SELECT e AS g, t, i, v FROM long WHERE t < cut)"""
    + _matrix("xf", "mf")
    + f""",
m1 AS (SELECT g, {_BENDS} AS m FROM mf JOIN best ON best.e = mf.g JOIN pens USING (place))"""
    + _eliminate("m1", "ef", "len(m) - 1")
    + f""",
pr AS (
  SELECT long.e AS g, t, any_value(penalty) AS penalty, any_value(mean_rmse) AS mean_rmse, sum(v * m[i][{_LAST}]) AS pred
  FROM long JOIN ef ON ef.g = long.e AND ef.k = {_LAST - 1} JOIN best ON best.e = long.e JOIN pens USING (place) WHERE t >= cut AND i < {_LAST} GROUP BY ALL
)"""
)


def _plain_forecasts() -> dict[str, str]:
    """``event_type, ts, actual, pred`` of the models that SQL states, as they come."""
    return {
        "moving_average": PRED + " SELECT event_type, ts, actual, pred FROM p WHERE model = 'moving_average'",
        "lag_linear": _recursive(_lag_regression("train", ", train")) + " SELECT event_type, ts, y AS actual, hat * std + mean AS pred FROM lr WHERE NOT train",
        "exp_smoothing": _recursive(HOLT)
        + " SELECT s.event_type, ts, y AS actual, level + (s.idx - last) * trend + season[((s.idx - last - 1) % 24) + 1] AS pred FROM s JOIN f ON s.event_type = f.event_type AND s.idx > f.last",
        "trend_waves": _recursive(TREND) + " SELECT event_type, ts, y AS actual, pred FROM pr JOIN s ON s.event_type = pr.g AND s.idx = pr.t",
        "sarima": _recursive(SARIMA) + " SELECT event_type, ts, y AS actual, pred FROM s JOIN fc ON fc.g = s.event_type AND fc.idx = s.idx AND pred IS NOT NULL",
    }


#: Each kind's models on the rows they all predict.
COMPARED = (
    "WITH p AS ("
    + " UNION ALL ".join(f"SELECT '{'one step' if m in ('moving_average', 'lag_linear') else 'ahead'}' AS forecast, '{m}' AS model, * FROM ({sql})" for m, sql in _plain_forecasts().items())
    + f"""),
c AS (SELECT event_type, forecast, ts FROM p GROUP BY ALL HAVING count(*) = CASE WHEN forecast = 'ahead' THEN 3 ELSE 2 END),
m AS (SELECT event_type, forecast, model, {METRICS} FROM p JOIN c USING (event_type, forecast, ts) GROUP BY ALL)
SELECT event_type, forecast, model, {", ".join(_r(m, m, 4) for m in ("MAE", "RMSE", "MAPE", "SMAPE", "R2"))},
  rank() OVER (PARTITION BY event_type, forecast ORDER BY RMSE)::INTEGER AS rank, NULL::VARCHAR AS reason FROM m"""
)


def _logged(sql: str) -> str:
    """The same over the logarithm of the counts."""
    return sql.replace("coalesce(c.c, 0)::DOUBLE AS y", "ln(1 + coalesce(c.c, 0)::DOUBLE) AS y")


ORACLES = {
    "hourly_demand": ALL + " SELECT ts, idx, y::BIGINT AS trip_count FROM s",
    "hourly_demand_by_type": TYPED + " SELECT event_type, ts, idx, y::BIGINT AS trip_count FROM s",
    "hourly_demand_by_user": _series(keys="user_id") + " SELECT user_id, ts, idx, y::BIGINT AS trip_count FROM s",
    "hourly_demand_common_range": _series(keys="user_id", common=True) + " SELECT user_id, ts, idx, y::BIGINT AS trip_count FROM s",
    "daily_orders": _series("orders", "o_orderdate", unit="day") + " SELECT ts, idx, y::BIGINT AS trip_count FROM s",
    "daily_shipments": _series("lineitem", "l_shipdate", "l_returnflag", "day")
    + " SELECT l_returnflag, ts, idx, y::BIGINT AS trip_count FROM s",
    "hourly_demand_bounded": _series(keys="event_type", where="ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
    + " SELECT event_type, ts, idx, y::BIGINT AS trip_count FROM s",
    "text_log_bounded": _series(keys="event_type", where="event_id % 10 <> 0 AND ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
    + " SELECT event_type, ts, idx, y::BIGINT AS trip_count FROM s",
    "series_extent": TYPED + " SELECT event_type, count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts FROM s GROUP BY 1",
    "head_preview": ALL + " SELECT ts, y::BIGINT AS trip_count FROM s ORDER BY ts LIMIT 5",
    "sample_hash": "SELECT event_id FROM events WHERE (event_id * 2654435761) % 4294967296 < 429496730",
    "sample_exact": """SELECT event_id FROM events ORDER BY (event_id * 2654435761) % 4294967296, event_id
LIMIT (SELECT round(count(*) * 0.1)::BIGINT FROM events)""",
    "union_slices": """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS n,
count(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END) AS n_price FROM orders GROUP BY ALL""",
    "ingest_missing_months": """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END::INTEGER AS run, count(*) AS n FROM orders GROUP BY ALL""",
    "scan_monthly_files": """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) AS n
FROM orders GROUP BY ALL""",
    "csv_roundtrip": TYPED + " SELECT event_type, ts, idx, y::BIGINT AS trip_count FROM s",
    "time_features": ALL + f"""
SELECT ts, hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS day_of_week, day(ts)::INTEGER AS day_of_month,
  month(ts)::INTEGER AS month, (isodow(ts) >= 6)::INTEGER AS is_weekend,
  {_r("sin(2 * pi() * hour(ts) / 24.0::DOUBLE)", "hour_sin")}, {_r("cos(2 * pi() * hour(ts) / 24.0::DOUBLE)", "hour_cos")},
  {_r("sin(2 * pi() * (isodow(ts) - 1) / 7.0::DOUBLE)", "day_sin")}, {_r("cos(2 * pi() * (isodow(ts) - 1) / 7.0::DOUBLE)", "day_cos")}
FROM s""",
    "normalize": ALL + f" SELECT ts, y::BIGINT AS trip_count, {_r('(y - avg(y) OVER ()) / stddev_samp(y) OVER ()', 'trip_count_normalized')} FROM s",
    "norm_params": TYPED + f" SELECT event_type, {_r('avg(y)', 'mean')}, {_r('stddev_samp(y)', 'std')} FROM s GROUP BY 1",
    "norm_params_train": TYPED
    + f" SELECT event_type, {_r('avg(y)', 'mean')}, {_r('stddev_samp(y)', 'std')} FROM s WHERE idx < floor(n * 0.8::DOUBLE) GROUP BY 1",
    "norm_params_roundtrip": _series(keys="user_id") + f" SELECT user_id, {_r('avg(y)', 'mean')}, {_r('stddev_samp(y)', 'std')} FROM s GROUP BY 1",
    "denormalize_roundtrip": TYPED + " SELECT event_type, ts, y, y AS y_back FROM s",
    "train_test_split": TYPED + """ SELECT event_type, CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split,
count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts FROM s GROUP BY ALL""",
    "moving_average_24": TYPED
    + f" SELECT event_type, ts, y, {_r('avg(y) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)', 'pred')} FROM s",
    "lag_windows": ALL + """,
sp AS (SELECT *, CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM s),
x AS (
  SELECT split, ts, y, count(*) OVER w AS n_x, lag(y, 24) OVER (PARTITION BY split ORDER BY idx) AS x_first,
    lag(y) OVER (PARTITION BY split ORDER BY idx) AS x_last, sum(y) OVER w AS x_sum
  FROM sp WINDOW w AS (PARTITION BY split ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
)
SELECT split, ts, y, n_x::INTEGER AS n_x, x_first, x_last, x_sum FROM x WHERE n_x = 24""",
    "recon_windows": ALL + f""",
x AS (SELECT idx, ts, lag(y, 23) OVER (ORDER BY idx) AS x_first, y AS x_last,
  avg(y) OVER (ORDER BY idx ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS m FROM s)
SELECT ts, x_first, x_last, {_r('m', 'x_mean')} FROM x WHERE idx >= 23""",
    "decompose_hourly": TYPED + f""",
t AS (
  SELECT *, CASE WHEN idx >= 12 AND idx < n - 12 THEN
    (sum(y) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)
     - (lag(y, 12) OVER (PARTITION BY event_type ORDER BY idx) + lead(y, 12) OVER (PARTITION BY event_type ORDER BY idx)) / 2) / 24 END AS trend
  FROM s WHERE n >= 48
),
ph AS (SELECT event_type, idx % 24 AS phase, avg(y - trend) AS p FROM t GROUP BY ALL),
se AS (SELECT event_type, phase, p - avg(p) OVER (PARTITION BY event_type) AS seasonal FROM ph)
SELECT t.event_type, ts, y AS observed, {_r('trend', 'trend', 8)}, {_r('seasonal', 'seasonal', 8)}, {_r('y - trend - seasonal', 'resid', 8)}
FROM t JOIN se ON t.event_type = se.event_type AND t.idx % 24 = se.phase""",
    "decompose_yearly": _series(unit="minute") + f""",
t AS (
  SELECT *, CASE WHEN idx >= 4380 AND idx < n - 4380 THEN
    (sum(y) OVER (ORDER BY idx ROWS BETWEEN 4380 PRECEDING AND 4380 FOLLOWING) - (lag(y, 4380) OVER (ORDER BY idx) + lead(y, 4380) OVER (ORDER BY idx)) / 2) / 8760 END AS trend
  FROM s WHERE n >= 17520
),
ph AS (SELECT idx % 8760 AS phase, avg(y - trend) AS p FROM t GROUP BY ALL),
se AS (SELECT phase, p - avg(p) OVER () AS seasonal FROM ph)
SELECT ts, y AS observed, {_r('trend', 'trend', 8)}, {_r('seasonal', 'seasonal', 8)}, {_r('y - trend - seasonal', 'resid', 8)} FROM t JOIN se ON t.idx % 8760 = se.phase""",
    "moving_average_long": _series(keys="event_type", unit="minute")
    + f" SELECT event_type, ts, y, {_r('avg(y) OVER (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 8640 PRECEDING AND 1 PRECEDING)', 'pred')} FROM s",
    "walk_forward_folds": WALK + " SELECT event_type, fold, train_end, test_end FROM f",
    "walk_forward_rmse": WALK + f" SELECT event_type, fold, {_r('rmse', 'rmse')} FROM sc",
    "walk_forward_summary": WALK + f" SELECT event_type, {_r('avg(rmse)', 'mean_rmse')}, {_r('stddev_pop(rmse)', 'std_rmse')} FROM sc GROUP BY 1",
    "forecast_metrics": RANKED + " SELECT * FROM mr",
    "metrics_with_gaps": PRED + f""",
m AS (SELECT event_type, model, {METRICS} FROM p WHERE idx % 5 <> 0 GROUP BY ALL)
SELECT event_type, model, {METRIC_SELECT}, rank() OVER (PARTITION BY event_type ORDER BY RMSE NULLS LAST)::INTEGER AS rank FROM m""",
    "forecast_metrics_head_aligned": TYPED + f""",
te AS (SELECT *, idx - floor(n * 0.8::DOUBLE)::BIGINT AS place FROM s WHERE idx >= floor(n * 0.8::DOUBLE)),
x AS (SELECT event_type, place - 24 AS place, avg(y) OVER (PARTITION BY event_type ORDER BY place ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS pred FROM te),
p AS (SELECT event_type, 'window_mean' AS model, te.y AS actual, x.pred FROM x JOIN te USING (event_type, place) WHERE place >= 0),
m AS (SELECT event_type, model, {METRICS} FROM p GROUP BY ALL)
SELECT event_type, model, {METRIC_SELECT} FROM m""",
    "model_ranking": RANKED + """,
u AS (
  SELECT event_type, model, 'MAE' AS metric, MAE AS value, MAE AS badness FROM mr
  UNION ALL SELECT event_type, model, 'RMSE', RMSE, RMSE FROM mr
  UNION ALL SELECT event_type, model, 'MAPE', MAPE, MAPE FROM mr
  UNION ALL SELECT event_type, model, 'R2', R2, -R2 FROM mr
)
SELECT event_type, metric, model, value, (rank() OVER (PARTITION BY event_type, metric ORDER BY badness NULLS LAST))::INTEGER AS rank FROM u""",
    "predictions_long": PRED + f" SELECT event_type, model, ts, actual, {_r('pred', 'pred')} FROM p",
    "predictions_wide": PRED + f"""
SELECT event_type, ts, actual,
  {_r("max(CASE WHEN model = 'moving_average' THEN pred END)", 'pred_moving_average')},
  {_r("max(CASE WHEN model = 'same_hour_yesterday' THEN pred END)", 'pred_same_hour_yesterday')}
FROM p WHERE idx >= n - 500 GROUP BY event_type, ts, actual""",
    "profile_recon_scores": PROFILE + f" SELECT event_type, ts, {_r('score', 'score')} FROM pr",
    "profile_recon_flags": FLAGGED + f" SELECT event_type, ts, {_r('score', 'score')}, {_r('threshold', 'threshold')}, is_anomaly FROM fl",
    "anomaly_points": FLAGGED + f" SELECT event_type, ts, y, {_r('score', 'score')} FROM fl WHERE is_anomaly",
    "anomaly_summary": FLAGGED
    + f" SELECT event_type, count(*) AS n, sum(is_anomaly::INTEGER)::BIGINT AS n_anom, {_r('avg(is_anomaly::INTEGER) * 100', 'pct')} FROM fl WHERE idx >= 23 GROUP BY 1",
    "anomaly_wide": TWO + f"""
SELECT ts, y::BIGINT AS trip_count,
  {_r("max(CASE WHEN method = 'profile' THEN score END)", 'anomaly_score_profile')},
  {_r("max(CASE WHEN method = 'moving_average' THEN score END)", 'anomaly_score_moving_average')}
FROM tw GROUP BY ts, y""",
    "anomaly_wide_rescaled": TWO + f"""
SELECT ts, {_r("y / 0.3::DOUBLE", 'trip_count')},
  {_r("max(CASE WHEN method = 'profile' THEN score END)", 'anomaly_score_profile')},
  {_r("max(CASE WHEN method = 'moving_average' THEN score END)", 'anomaly_score_moving_average')}
FROM tw GROUP BY ts, y""",
    "display_threshold_flags": PROFILE + f""",
tail AS (SELECT * FROM pr WHERE idx >= n - 500),
t AS (SELECT event_type, quantile_cont(score, 0.95) AS threshold FROM tail WHERE score > 0 GROUP BY 1)
SELECT event_type, ts, {_r('score', 'score')}, {_r('threshold', 'threshold')}, score > threshold AS flag FROM tail JOIN t USING (event_type)""",
    "score_chart": TWO + f""",
tail AS (SELECT * FROM tw WHERE idx >= n - 500),
t AS (SELECT method, quantile_cont(score, 0.95) AS threshold FROM tail WHERE score > 0 GROUP BY 1)
SELECT method, ts, {_r('score', 'score')}, {_r('threshold', 'p95')} FROM tail JOIN t USING (method)""",
    "hist50": TYPED + f""",
b AS (SELECT event_type, min(y) AS a, max(y) AS z FROM s GROUP BY 1),
h AS (SELECT event_type, least(floor((y - a) / (z - a) * 50), 49)::INTEGER AS bin, count(*) AS n FROM s JOIN b USING (event_type) GROUP BY ALL)
SELECT b.event_type, g.bin::INTEGER AS bin, {_r('a + g.bin * ((z - a) / 50)', 'lo')}, {_r('a + (g.bin + 1) * ((z - a) / 50)', 'hi')}, coalesce(h.n, 0) AS n
FROM b CROSS JOIN range(0, 50) g(bin) LEFT JOIN h ON h.event_type = b.event_type AND h.bin = g.bin""",
    "kde": TYPED + f""",
b AS (SELECT event_type, min(y) AS a, max(y) AS z, stddev_samp(y) * pow(count(*), -0.2::DOUBLE) AS h, count(*) AS rows FROM s GROUP BY 1),
v AS (SELECT event_type, y, count(*) AS c FROM s GROUP BY ALL),
g AS (SELECT b.*, i::INTEGER AS point, a + (z - a) * i / 199.0::DOUBLE AS x FROM b, range(0, 200) r(i))
SELECT event_type, point, {_r('any_value(x)', 'x')},
  {_r('sum(c * exp(-((x - y) / h) * ((x - y) / h) / 2)) / any_value(rows * h * sqrt(2 * pi()))', 'density')}
FROM g JOIN v USING (event_type) GROUP BY event_type, point""",
    "box_by_weekday": _box("weekday"),
    "box_by_hour": _box("hour"),
    "box_value": """WITH q AS (
  SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1
)
SELECT event_type, n, q1, med, q3,
  min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_lo,
  max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_out
FROM events JOIN q USING (event_type) GROUP BY ALL""",
    "kde_value": f"""WITH b AS (SELECT event_type, min(value) AS a, max(value) AS z, stddev_samp(value) * pow(count(value), -0.2::DOUBLE) AS h, count(value) AS rows FROM events GROUP BY 1),
v AS (SELECT event_type, value AS y, count(*) AS c FROM events GROUP BY ALL),
g AS (SELECT b.*, i::INTEGER AS point, a + (z - a) * i / 199.0::DOUBLE AS x FROM b, range(0, 200) r(i))
SELECT event_type, point, {_r('any_value(x)', 'x')},
  {_r('sum(c * exp(-((x - y) / h) * ((x - y) / h) / 2)) / any_value(rows * h * sqrt(2 * pi()))', 'density')}
FROM g JOIN v USING (event_type) GROUP BY event_type, point""",
    "percentiles_value": "SELECT event_type, " + ", ".join(_r(f"quantile_cont(value, {p / 100})", f"p{p}") for p in (1, 25, 50, 75, 95, 99)) + " FROM events GROUP BY 1",
    "df_lag0": TYPED + f""",
d AS (
  SELECT event_type, lag(y) OVER (PARTITION BY event_type ORDER BY idx) AS x, y - lag(y) OVER (PARTITION BY event_type ORDER BY idx) AS dy FROM s
),
r AS (
  SELECT event_type, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, count(*) AS m FROM d WHERE x IS NOT NULL GROUP BY 1
)
SELECT event_type, {_r('b / sqrt((syy - b * b * sxx) / (m - 2) / sxx)', 'tau')} FROM r""",
    "holt_winters_fixed": _recursive(_smoothing("(0.3::DOUBLE, 0.05::DOUBLE, 0.1::DOUBLE)", "true"))
    + f" SELECT event_type, idx, y, {_r('pred', 'pred')} FROM hw WHERE idx >= 0",
    "holt_winters_grid": _recursive(HOLT)
    + f"""
SELECT s.event_type, ts, {_r('level + (s.idx - last) * trend + season[((s.idx - last - 1) % 24) + 1]', 'pred')},
  a AS alpha, b AS beta, c AS gamma, {_r('sse', 'sse')}
FROM s JOIN f ON s.event_type = f.event_type AND s.idx > f.last""",
    "hourly_demand_stream": """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS ts, count(*) AS trip_count FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 hour <= (SELECT max(ts) - INTERVAL 1 hour FROM events) GROUP BY ALL""",
    "stream_gap_filled": f"""WITH m AS (SELECT max(ts) - INTERVAL 1 hour AS mark FROM events),
c AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS ts, count(*) AS c FROM events GROUP BY ALL),
sp AS (SELECT event_type, unnest(generate_series(min(ts), date_trunc('hour', any_value(mark))::TIMESTAMP - INTERVAL 1 hour, INTERVAL 1 hour)) AS ts FROM c, m GROUP BY event_type),
s AS (SELECT event_type, ts, coalesce(c, 0)::DOUBLE AS y FROM sp LEFT JOIN c USING (event_type, ts))
SELECT event_type, ts, y, {_r('avg(y) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)', 'pred')} FROM s""",
    "adf": _recursive(ADF)
    + f""" SELECT g AS event_type, {_r('tau', 'tau')}, {_r('pvalue', 'pvalue')},
{', '.join(_r(_surface(c), c) for c in CRITICAL)}, lag::INTEGER AS usedlag, nobs, pvalue < 0.05 AS is_stationary FROM pv""",
    "fourier_trend_forecast": _recursive(TREND)
    + f" SELECT event_type, ts, y, {_r('pred', 'pred')} FROM pr JOIN s ON s.event_type = pr.g AND s.idx = pr.t",
    "lag_regression_lr": _recursive(_lag_regression("train", ", train"))
    + f" SELECT event_type, ts, y AS actual, {_r('hat * std + mean', 'pred')} FROM lr WHERE NOT train",
    "sequence_residual": _recursive(SEQUENCE)
    + f" SELECT event_type, ts, y, {_r('score', 'score')}, {_r('threshold', 'threshold')}, idx >= 23 AND score > threshold AS is_anomaly FROM pr JOIN t USING (event_type)",
    "pca_recon": _recursive(PATTERNS)
    + f" SELECT event_type, ts, y, {_r('score', 'score')}, {_r('threshold', 'threshold')}, idx >= 23 AND score > threshold AS is_anomaly FROM pr JOIN t USING (event_type)",
    "sarima_css": _recursive(SARIMA)
    + f""" SELECT event_type, ts, y, {_r('pred', 'pred')}, {_r('fit + 14', 'aic')}, {_r('fit + ln(nobs) * 7', 'bic')}
FROM s JOIN fc ON fc.g = s.event_type AND fc.idx = s.idx AND pred IS NOT NULL JOIN ic ON ic.g = s.event_type""",
    "training_history": _recursive(_adam()) + f" {_epoch_loss('ga', 'train')} UNION ALL {_epoch_loss('gb', 'test')}",
    "model_artifact": _recursive(_adam())
    + f""" SELECT event_type, ts, y AS actual, {_r('list_dot_product(x[1:25], b) * std + mean', 'pred')} FROM full_, ep WHERE k = {EPOCHS} AND NOT train""",
    "series_csv_roundtrip": ALL + " SELECT ts, y::BIGINT AS trip_count FROM s",
    "processed_roundtrip": TYPED
    + " SELECT event_type, CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split, hour(ts)::INTEGER AS hour, count(*) AS n, sum(y) AS total, max(ts) AS last FROM s GROUP BY ALL",
    "floored_events": "SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS minute, count(*) AS n FROM events GROUP BY ALL",
    "regression_frames": TYPED
    + """ SELECT event_type, ts AS ds, y, 'train' AS part FROM s WHERE idx < floor(n * 0.8::DOUBLE) AND idx % 7 <> 0
UNION ALL SELECT event_type, ts, NULL, 'future' FROM s WHERE idx >= floor(n * 0.8::DOUBLE)""",
    "metrics_report": RANKED
    + """, named AS (SELECT *, CASE model WHEN 'moving_average' THEN 'Moving Average' ELSE 'Same Hour Yesterday' END AS title FROM mr)
SELECT event_type, model, title, model AS file_name, string_split(model, '_')[-1] AS last_part, printf('%-20s %10.2f %10.2f', title, round(MAE, 2), round(RMSE, 2)) AS line FROM named""",
    "walk_forward_callback": WALK
    + f""",
ph AS (SELECT f.event_type, fold, idx % 24 AS p, avg(y) AS m FROM s JOIN f ON s.event_type = f.event_type AND idx < train_end GROUP BY ALL)
SELECT f.event_type, f.fold, {_r('sqrt(avg((y - m) * (y - m)))', 'rmse')}
FROM s JOIN f ON s.event_type = f.event_type AND idx >= train_end AND idx < test_end JOIN ph ON ph.event_type = f.event_type AND ph.fold = f.fold AND p = idx % 24 GROUP BY ALL""",
    "ingest_after_failure": """SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 3 END::INTEGER AS run, count(*) AS n FROM orders GROUP BY ALL""",
    "fourier_trend_tuned": _recursive(TUNED)
    + f" SELECT event_type, ts, y, {_r('pred', 'pred')}, penalty, {_r('mean_rmse', 'mean_rmse')} FROM pr JOIN s ON s.event_type = pr.g AND s.idx = pr.t",
    "sarima_orders": " UNION ALL ".join(f"SELECT * FROM ({_arima_rows(name, order)})" for name, order in (("(1,0,1)", Order(1, 0, 1)), ("(0,1,1)(0,1,1,24)", Order(0, 1, 1, 0, 1, 1, 24)))),
    "isolation_forest": _recursive(FOREST)
    + f" SELECT ts, y, {_r('score', 'score')}, {_r('threshold', 'threshold')}, idx >= 23 AND score > threshold AS is_anomaly FROM pr, t",
}
ORACLES |= {
    "compare_models": COMPARED,
    "fourier_trend_target": _logged(ORACLES["fourier_trend_forecast"]).replace("ts, y,", "ts, round(y, 6) + 0.0 AS y,"),
    "profile_recon_target": _logged(ORACLES["profile_recon_flags"]),
}
