"""DuckDB SQL that recomputes the registered queries from the same tables.

Shared steps are named common table expressions; ``with_steps`` puts the ones a query
needs, in order, before its final SELECT. Eigenvectors come from power iteration with
deflation in recursive SQL, so components and everything after them are checked in full.
"""

from __future__ import annotations

from eigenlake.registry.fixtures import FEATURES, SERIES_WINDOW, VECTOR_WIDTH

D = len(FEATURES)
POWER_STEPS = 400

F1 = """f1 AS (
  SELECT l_orderkey AS row_id, count(*)::DOUBLE AS n, sum(l_quantity) AS qty,
         sum(l_extendedprice) AS price, max(l_extendedprice) AS max_price, avg(l_discount) AS disc,
         (count(*) % 3)::INTEGER AS target, max(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey)"""

DIRTY = """dirty AS (
  SELECT row_id, CASE WHEN row_id % 7 <> 0 THEN qty END AS qty,
         CASE WHEN row_id % 11 <> 0 THEN price END AS price,
         CASE WHEN row_id % 13 <> 0 THEN disc END AS disc,
         5.0::DOUBLE AS five, target, flag FROM f1)"""


def split_step(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || row_id::VARCHAR)) <=
    (SELECT greatest(2, least(count(*) - 1, round_even(count(*) * 0.8, 0)))::BIGINT FROM {source}) AS is_train
  FROM {source})"""


SPLIT = split_step("f1", "sp")
DIRTY_SPLIT = split_step("dirty", "dsp")

DIRTY_FEATURES = ("qty", "price", "disc", "five")

MEDIANS = "med AS (SELECT " + ", ".join(f"median({f}) AS {f}" for f in DIRTY_FEATURES) + " FROM dsp WHERE is_train)"
IMPUTED = (
    "imp AS (SELECT row_id, is_train, "
    + ", ".join(f"coalesce(dsp.{f}, med.{f}) AS {f}" for f in DIRTY_FEATURES)
    + " FROM dsp, med)"
)
STATE = "state AS (" + " UNION ALL ".join(
    f"""SELECT {i}::INTEGER AS pos, '{f}' AS feature, (SELECT {f} FROM med) AS median, avg({f}) AS mean,
  CASE WHEN stddev_pop({f}) <= 1e-8 THEN 1.0 ELSE stddev_pop({f}) END AS scale,
  stddev_pop({f}) <= 1e-8 AS is_constant FROM imp WHERE is_train"""
    for i, f in enumerate(DIRTY_FEATURES)
) + ")"

# Clean order profile, standardised by its training rows, as lists.
STATS = "st AS (SELECT " + ", ".join(
    f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}, median({f}) AS d_{f}" for f in FEATURES
) + " FROM sp WHERE is_train)"
Z = (
    "z AS (SELECT row_id, is_train, target, flag, ["
    + ", ".join(f"({f} - m_{f}) / s_{f}" for f in FEATURES)
    + "] AS f FROM sp, st)"
)
MU = f"mu AS (SELECT list(m ORDER BY i) AS mu FROM (SELECT i, avg(f[i]) AS m FROM z, range(1, {D + 1}) a(i) WHERE is_train GROUP BY i))"
COV = f"""cov AS (
  SELECT i, j, covar_samp(f[i], f[j]) AS v FROM z, range(1, {D + 1}) a(i), range(1, {D + 1}) b(j)
  WHERE is_train GROUP BY i, j)"""
MATRIX = "cm1 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM cov GROUP BY i))"


def _power(c: int) -> str:
    start = "[" + ", ".join(f"{1.0 - 0.17 * i:.2f}" for i in range(D)) + "]::DOUBLE[]"
    steps = f"""it{c}(s, v) AS (
  SELECT 0, {start}
  UNION ALL
  SELECT s + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT s, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM it{c}, cm{c} WHERE s < {POWER_STEPS})),
e{c} AS (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS lam
  FROM it{c}, cm{c} WHERE s = {POWER_STEPS})"""
    if c < D:
        steps += f""",
cm{c + 1} AS (SELECT list_transform(range(1, {D + 1}), lambda i:
    list_transform(range(1, {D + 1}), lambda j: m[i][j] - lam * v[i] * v[j])) AS m FROM cm{c}, e{c})"""
    return steps


EIGEN = ",\n".join(_power(c) for c in range(1, D + 1)) + """,
eig AS (SELECT component, lam, list_transform(v, lambda x: x * sgn) AS v FROM (
  SELECT component, lam, v,
    CASE WHEN v[list_position(list_transform(v, lambda x: abs(x)), list_max(list_transform(v, lambda x: abs(x))))] < 0
         THEN -1.0 ELSE 1.0 END AS sgn
  FROM (""" + " UNION ALL ".join(f"SELECT {c}::INTEGER AS component, greatest(lam, 0) AS lam, v FROM e{c}" for c in range(1, D + 1)) + """))),
spec AS (SELECT component, lam AS variance, lam / sum(lam) OVER () AS ratio,
  sum(lam) OVER (ORDER BY component) / sum(lam) OVER () AS cumulative FROM eig),
pick AS (SELECT min(component) AS k FROM spec WHERE cumulative >= 0.95)"""

NAMES = "names AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURES)) + ") t(pos, feature))"
LOADINGS = f"""load AS (
  SELECT component, pos::INTEGER AS pos, feature, v[pos + 1] AS loading FROM eig, names)"""
SCORES = f"""vs AS (SELECT list(v ORDER BY component) AS vs FROM eig),
sc AS (SELECT row_id, is_train, target, flag, f, list_transform(vs, lambda v: list_dot_product(cf, v)) AS z
  FROM (SELECT z.*, list_transform(range(1, {D + 1}), lambda i: f[i] - mu[i]) AS cf FROM z, mu), vs)"""


def rebuilt_step(k: str, name: str = "rb") -> str:
    """Rows rebuilt from the first k components (k is SQL)."""
    return f"""{name} AS (SELECT row_id, is_train, f, list_transform(range(1, {D + 1}), lambda i:
    mu[i] + list_sum(list_transform(range(1, kk + 1), lambda c: z[c] * vs[c][i]))) AS r
  FROM sc, mu, vs, (SELECT {k} AS kk))"""


SPECTRAL = [F1, SPLIT, STATS, Z, MU, COV, MATRIX, EIGEN]

V = "v AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS f, label FROM embeddings)"
PAIRS = "pairs AS (SELECT a.row_id AS i, b.row_id AS j, a.label AS li, b.label AS lj, list_distance(a.f, b.f) AS d FROM v a, v b WHERE a.row_id <> b.row_id)"
CELLS = f"cells AS (SELECT row_id, label, k, f[k] AS x FROM v, range(1, {VECTOR_WIDTH + 1}) r(k))"
CENTROIDS = "cen AS (SELECT label, list(m ORDER BY k) AS c, any_value(n) AS n FROM (SELECT label, k, avg(x) AS m, count(*) AS n FROM cells GROUP BY label, k) GROUP BY label)"
OWN = "own AS (SELECT v.row_id, v.label, list_distance(f, c) AS d FROM v JOIN cen USING (label))"
SILHOUETTE = """sil AS (
  SELECT row_id, CASE WHEN same IS NULL THEN 0.0 ELSE (other - same) / greatest(same, other) END AS s FROM (
    SELECT i AS row_id, max(CASE WHEN li = lj THEN m END) AS same, min(CASE WHEN li <> lj THEN m END) AS other
    FROM (SELECT i, li, lj, avg(d) AS m FROM pairs GROUP BY i, li, lj) GROUP BY i))"""
CONTINGENCY = "ct AS (SELECT row_id % 4 AS reference, label AS cluster, count(*)::DOUBLE AS n FROM v GROUP BY ALL)"

# One profile per customer, under the names of the order profile, so that its steps apply; small enough for all pairs.
CUSTOMERS = """f1 AS (
  SELECT c_custkey AS row_id, count(o_orderkey)::DOUBLE AS n, c_acctbal::DOUBLE AS qty, coalesce(sum(o_totalprice), 0)::DOUBLE AS price,
         coalesce(max(o_totalprice), 0)::DOUBLE AS max_price, c_nationkey::DOUBLE AS disc,
         (c_custkey % 3)::INTEGER AS target, c_mktsegment AS flag
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def started_clustering(points: str, ks: list[int], steps: int, starts: str, p: str = "") -> str:
    """K-means of every representation in ``points(rep, row_id, f, ref)`` for all ks, from the first k rows of
    ``starts(place, row_id)`` in so many steps, and all metrics of what it reaches: ``met(rep, k, metric, value)``.

    ``p`` goes before the names of the steps.
    """
    axes = f"range(1, (SELECT max(len(f)) + 1 FROM {points})) r(x)"
    parts = [
        f"{p}kk AS (SELECT unnest({ks}) AS k)",
        f"{p}c0 AS MATERIALIZED (SELECT rep, k, place::INTEGER AS label, f AS c FROM {points} JOIN {starts} USING (row_id), {p}kk WHERE place < k)",
    ]
    for s in range(steps + 1):
        parts.append(f"""{p}a{s} AS MATERIALIZED (SELECT rep, k, row_id, any_value(f) AS f, any_value(ref) AS ref,
            (arg_min(label, [list_distance(f, c), label]))::INTEGER AS label FROM {points} JOIN {p}c{s} USING (rep) GROUP BY rep, k, row_id)""")
        if s < steps:
            parts.append(f"""{p}c{s + 1} AS MATERIALIZED (SELECT rep, k, label, list(m ORDER BY x) AS c FROM (
              SELECT rep, k, label, x, avg(f[x]) AS m FROM {p}a{s}, {axes} WHERE x <= len(f) GROUP BY ALL) GROUP BY rep, k, label)""")
    lab = f"{p}a{steps}"
    parts += [
        f"""{p}cen AS (SELECT rep, k, label, list(m ORDER BY x) AS c, any_value(n) AS n FROM (
          SELECT rep, k, label, x, avg(f[x]) AS m, count(*) AS n FROM {lab}, {axes} WHERE x <= len(f) GROUP BY ALL) GROUP BY rep, k, label)""",
        f"{p}own AS (SELECT rep, k, row_id, label, list_distance(f, c) AS d FROM {lab} JOIN {p}cen USING (rep, k, label))",
        f"""{p}pr AS MATERIALIZED (SELECT a.rep, a.row_id AS i, b.row_id AS j, list_distance(a.f, b.f) AS d
          FROM {points} a JOIN {points} b ON a.rep = b.rep AND a.row_id <> b.row_id)""",
        f"""{p}sil AS (SELECT rep, k, CASE WHEN same IS NULL THEN 0.0 ELSE (other - same) / greatest(same, other) END AS s FROM (
          SELECT rep, k, i, max(CASE WHEN li = lj THEN m END) AS same, min(CASE WHEN li <> lj THEN m END) AS other FROM (
            SELECT a.rep, a.k, i, a.label AS li, b.label AS lj, avg(d) AS m FROM {p}pr
            JOIN {lab} a ON a.rep = {p}pr.rep AND a.row_id = i JOIN {lab} b ON b.rep = a.rep AND b.k = a.k AND b.row_id = j GROUP BY ALL)
          GROUP BY rep, k, i))""",
        f"{p}gm AS (SELECT rep, list(m ORDER BY x) AS g FROM (SELECT rep, x, avg(f[x]) AS m FROM {points}, {axes} WHERE x <= len(f) GROUP BY ALL) GROUP BY rep)",
        f"{p}bw AS (SELECT rep, k, sum(n * list_distance(c, g) ** 2) AS b, count(*) AS cl FROM {p}cen JOIN {p}gm USING (rep) GROUP BY rep, k)",
        f"{p}k2 AS (SELECT rep, k, label, s, c FROM (SELECT rep, k, label, avg(d) AS s FROM {p}own GROUP BY ALL) JOIN {p}cen USING (rep, k, label))",
        f"{p}ct AS (SELECT rep, k, ref, label, count(*)::DOUBLE AS n FROM {lab} GROUP BY ALL)",
        f"{p}ra AS (SELECT rep, k, ref, sum(n) AS n FROM {p}ct GROUP BY ALL)",
        f"{p}ca AS (SELECT rep, k, label, sum(n) AS n FROM {p}ct GROUP BY ALL)",
        f"""{p}q AS (SELECT * FROM (SELECT rep, k, sum(n) AS t, sum(n) * (sum(n) - 1) / 2 AS p, sum(n * (n - 1) / 2) AS same FROM {p}ct GROUP BY ALL)
          JOIN (SELECT rep, k, sum(n * (n - 1) / 2) AS a, sum(n) AS ta, -sum(n * ln(n)) AS xr FROM {p}ra GROUP BY ALL) USING (rep, k)
          JOIN (SELECT rep, k, sum(n * (n - 1) / 2) AS b, -sum(n * ln(n)) AS xc FROM {p}ca GROUP BY ALL) USING (rep, k)
          JOIN (SELECT rep, k, -sum(n * ln(n)) AS xb FROM {p}ct GROUP BY ALL) USING (rep, k))""",
        f"""{p}met AS (
          SELECT rep, k, 'inertia' AS metric, sum(d * d) AS value FROM {p}own GROUP BY ALL
          UNION ALL SELECT rep, k, 'calinski_harabasz', any_value(b) * (count(*) - any_value(cl)) / (sum(d * d) * (any_value(cl) - 1))
            FROM {p}own JOIN {p}bw USING (rep, k) GROUP BY ALL
          UNION ALL SELECT rep, k, 'davies_bouldin', avg(m) FROM (SELECT a.rep, a.k, a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS m
            FROM {p}k2 a JOIN {p}k2 b ON a.rep = b.rep AND a.k = b.k AND a.label <> b.label GROUP BY ALL) GROUP BY ALL
          UNION ALL SELECT rep, k, 'silhouette', avg(s) FROM {p}sil GROUP BY ALL
          UNION ALL SELECT rep, k, 'adjusted_rand_index', (same - a * b / p) / ((a + b) / 2 - a * b / p) FROM {p}q
          UNION ALL SELECT rep, k, 'normalized_mutual_information',
            ((ln(t) + xr / t) + (ln(t) + xc / t) - (ln(t) + xb / t)) / (((ln(t) + xr / t) + (ln(t) + xc / t)) / 2) FROM {p}q)""",
    ]
    return ",\n".join(parts)


SERIES = """hours AS (SELECT event_type AS series_id, (floor(epoch(ts) / 3600))::BIGINT AS t FROM events),
counts AS (SELECT series_id, t, count(*)::DOUBLE AS value FROM hours GROUP BY ALL),
span AS (SELECT min(t) AS low, max(t) AS high FROM counts),
ser AS (SELECT c.series_id, c.t, coalesce(counts.value, 0.0) AS value
  FROM (SELECT series_id, unnest(range(low, high + 1)) AS t FROM (SELECT DISTINCT series_id FROM counts), span) c
  LEFT JOIN counts USING (series_id, t))"""
WINDOWS = f"""win AS (SELECT series_id, t, w FROM (
  SELECT series_id, t, list(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND {SERIES_WINDOW - 1} FOLLOWING) AS w
  FROM ser) WHERE len(w) = {SERIES_WINDOW})"""
DENOISED = f"""sg AS (SELECT series_id, i, list(v ORDER BY j) AS r FROM (
    SELECT series_id, i, j, sum(w[i] * w[j]) AS v FROM win, range(1, {SERIES_WINDOW + 1}) a(i), range(1, {SERIES_WINDOW + 1}) b(j) GROUP BY ALL)
  GROUP BY series_id, i),
sm AS (SELECT series_id, list(r ORDER BY i) AS m FROM sg GROUP BY series_id),
sit(s, series_id, v) AS (
  SELECT 0, series_id, list_transform(range({SERIES_WINDOW}), lambda x: 1.0::DOUBLE) FROM sm
  UNION ALL
  SELECT s + 1, series_id, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT s, series_id, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM sit JOIN sm USING (series_id) WHERE s < 60)),
sv AS (SELECT series_id, v FROM sit WHERE s = 60),
den AS (SELECT series_id, t + p - 1 AS t, avg(score * v[p]) AS denoised FROM (
    SELECT series_id, t, v, list_dot_product(w, v) AS score FROM win JOIN sv USING (series_id)), range(1, {SERIES_WINDOW + 1}) a(p)
  GROUP BY series_id, t + p - 1)"""

EVENT_CELLS = """ev AS (SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'Infinity'::DOUBLE ELSE value END AS value,
  5.0::DOUBLE AS five, CASE WHEN event_id % 13 = 0 THEN 'n.a.' ELSE (event_id % 100)::VARCHAR END AS num_text
  FROM events)"""

PERPLEXITY = 30.0


def calibration(distances: str, perplexity: float) -> str:
    """Bisection per row over the steps in ``distances``, which end in dl(row_id, d)."""
    return f"""{distances},
bis(s, row_id, beta, lo, hi, used, total, entropy, done) AS (
  SELECT 0, row_id, 1.0::DOUBLE, '-Infinity'::DOUBLE, 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, false FROM dl
  UNION ALL
  SELECT s + 1, row_id,
    CASE WHEN e > goal THEN CASE WHEN isinf(hi) THEN beta * 2 ELSE (beta + hi) / 2 END
         ELSE CASE WHEN isinf(lo) THEN beta / 2 ELSE (beta + lo) / 2 END END,
    CASE WHEN e > goal THEN beta ELSE lo END, CASE WHEN e <= goal THEN beta ELSE hi END,
    beta, tot, e, abs(e - goal) < 1e-5
  FROM (SELECT *, ln({perplexity}) AS goal,
      CASE WHEN tot <= 1e-300 THEN ln(len(d)) ELSE ln(tot) + beta * list_dot_product(d, w) / tot END AS e
    FROM (SELECT *, list_sum(w) AS tot FROM (
      SELECT bis.*, d, list_transform(d, lambda x: exp(-x * beta)) AS w
      FROM bis JOIN dl USING (row_id) WHERE s < 60 AND NOT done)))),
cal AS MATERIALIZED (SELECT row_id, arg_max(used, s) AS beta, arg_max(total, s) AS total, arg_max(entropy, s) AS entropy
  FROM bis WHERE s > 0 GROUP BY row_id)"""


CALIBRATION = calibration(
    """sq AS MATERIALIZED (SELECT a.row_id AS i, b.row_id AS j,
    greatest(list_dot_product(a.f, a.f) + list_dot_product(b.f, b.f) - 2 * list_dot_product(a.f, b.f), 0) AS d2
  FROM v a, v b WHERE a.row_id <> b.row_id),
dl AS MATERIALIZED (SELECT i AS row_id, list(d2 ORDER BY j) AS d FROM sq GROUP BY i)""",
    PERPLEXITY,
)
NEIGHBOUR_PERPLEXITY = 5.0
NEIGHBOUR_CALIBRATION = calibration(
    """near AS (SELECT i, j, d * d AS d2 FROM (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs) WHERE rank <= 15),
dl AS (SELECT i AS row_id, list(d2 ORDER BY d2, j) AS d FROM near GROUP BY i)""",
    NEIGHBOUR_PERPLEXITY,
)
NEIGHBOUR_WEIGHTS = """np AS (SELECT i, j, CASE WHEN total <= 1e-300 THEN 1.0 / 15 ELSE exp(-d2 * beta) / total END AS p
  FROM near JOIN cal ON cal.row_id = i)"""
JOINT = """nn AS (SELECT count(*) AS n FROM v),
cond AS MATERIALIZED (SELECT i, j, CASE WHEN total <= 1e-300 THEN 1.0 / (n - 1) ELSE exp(-d2 * beta) / total END AS p
  FROM sq JOIN cal ON cal.row_id = i, nn),
raw AS MATERIALIZED (SELECT a.i, a.j, greatest((a.p + b.p) / (2 * n), 1e-12) AS w FROM cond a JOIN cond b ON a.i = b.j AND a.j = b.i, nn
  UNION ALL SELECT row_id, row_id, 1e-12 FROM v),
joint AS (SELECT i, j, w / (SELECT sum(w) FROM raw) AS w FROM raw)"""


def with_steps(steps: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(steps) + "\n" + select


def r(expression: str, digits: int = 6) -> str:
    """Rounded without a negative zero, as in the Spark queries."""
    return f"(round({expression}, {digits}) + 0.0)"
