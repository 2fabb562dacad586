"""Independent DuckDB SQL for each registered query (the correctness oracle).

Each query is ``WITH <flight derivation> <select>`` over the pre-registered
test-data views. Written from the rules in FIXTURES.md and the operator
semantics, not generated from the Spark plans.

Engine differences handled here (see SURVEY §5.3): Spark rounds the shortest
decimal text of a double HALF_UP, so doubles are rounded through their text
form (DuckDB also prints the shortest round-trip text); Spark double -> int
casts truncate; Spark integer sums are BIGINT. Measures whose last bits depend
on the summation algorithm (correlation, standard deviation) are first rounded
to 10 places on both sides (``r_stable``).
"""

from __future__ import annotations

from tarmac.schema import CAUSES


def r(expr: str, n: int) -> str:
    """Round like Spark's ``round(double, n)`` (HALF_UP on the shortest decimal text)."""
    return (f"CAST(ROUND(TRY_CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), "
            f"{n}) AS DOUBLE)")


def r_stable(expr: str, n: int) -> str:
    """``r`` after collapsing summation-order noise at 10 places (see ``stable_round``)."""
    return r(r(expr, 10), n)


def _hhmm(m: str) -> str:
    return f"(floor((({m}) % 1440) / 60) * 100 + ({m}) % 60)"


def _share(c: str) -> str:
    return f"CASE WHEN late IS NOT NULL THEN CASE WHEN {c} THEN floor(late / 2) ELSE 0 END END"


FLIGHTS_RAW = f"""
fx_src AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_shipdate AS DATE) AS d,
         c.c_nationkey AS cn, s.s_nationkey AS sn,
         l.l_orderkey * 31 + l.l_linenumber * 17 + l.l_partkey * 7 + l.l_suppkey * 3 AS h
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
fx_a AS (
  SELECT *, h % 25 AS hr,
         CASE WHEN h % 25 = 24 THEN 0 ELSE h % 60 END AS mi,
         CASE WHEN h % 499 = 0 THEN 2000 WHEN h % 503 = 0 THEN -200
              WHEN h % 19 = 0 THEN 60 + h % 240 ELSE h % 71 - 25 END AS dd,
         l_partkey % 41 - 22 AS adj, 5 + l_partkey % 30 AS tox, 2 + l_suppkey % 15 AS tix,
         100 + 120 * abs(cn - sn) AS dist,
         CASE WHEN h % 53 = 0 THEN 1 ELSE 0 END AS canc
  FROM fx_src
),
fx_b AS (
  SELECT *, hr * 60 + mi AS depm, dd + adj AS ad, 30 + floor(dist / 8) AS air,
         CASE WHEN h % 197 = 0 AND canc = 0 THEN 1 ELSE 0 END AS dv
  FROM fx_a
),
fx_c AS (
  SELECT *, tox + air + tix AS el,
         CASE WHEN ad >= 15 AND canc = 0 AND dv = 0 THEN ad END AS late
  FROM fx_b
),
fx_one AS (
  SELECT f.l_orderkey,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%Y-%m-%d') AS fl_date,
    'C' || CAST(l_suppkey % 12 AS VARCHAR) AS op_unique_carrier,
    CAST(l_partkey AS DOUBLE) AS op_carrier_fl_num,
    'N' || CAST(cn AS VARCHAR) AS origin, ro.r_name || ' City' AS origin_city_name,
    no.n_name AS origin_state_nm,
    'N' || CAST(sn AS VARCHAR) AS dest, rd.r_name || ' City' AS dest_city_name,
    nd.n_name AS dest_state_nm,
    CAST(hr * 100 + mi AS INTEGER) AS crs_dep_time,
    CASE WHEN canc = 0 THEN CAST({_hhmm('depm + dd + 2880')} AS DOUBLE) END AS dep_time,
    CASE WHEN canc = 0 THEN CAST(dd AS DOUBLE) END AS dep_delay,
    CASE WHEN canc = 0 THEN CAST(tox AS DOUBLE) END AS taxi_out,
    CASE WHEN canc = 0 THEN CAST({_hhmm('depm + dd + tox + 2880')} AS DOUBLE) END AS wheels_off,
    CASE WHEN canc = 0 THEN CAST({_hhmm('depm + dd + tox + air + 2880')} AS DOUBLE) END AS wheels_on,
    CASE WHEN canc = 0 THEN CAST(tix AS DOUBLE) END AS taxi_in,
    CAST({_hhmm('depm + el')} AS INTEGER) AS crs_arr_time,
    CASE WHEN canc = 0 AND dv = 0 THEN CAST({_hhmm('depm + el + ad + 2880')} AS DOUBLE) END AS arr_time,
    CASE WHEN canc = 0 AND dv = 0 AND h % 61 <> 0 THEN CAST(ad AS DOUBLE) END AS arr_delay,
    CAST(canc AS INTEGER) AS cancelled,
    CASE WHEN canc = 1 THEN substr('ABCD', CAST(h % 4 + 1 AS INTEGER), 1) END AS cancellation_code,
    CAST(dv AS INTEGER) AS diverted,
    CAST(el AS DOUBLE) AS crs_elapsed_time,
    CASE WHEN canc = 0 AND dv = 0 THEN CAST(el + adj AS DOUBLE) END AS actual_elapsed_time,
    CASE WHEN canc = 0 AND dv = 0 THEN CAST(air AS DOUBLE) END AS air_time,
    CAST(dist AS DOUBLE) AS distance,
    CAST(late - floor(late / 2) AS INTEGER) AS carrier_delay,
    CAST({_share('h % 5 = 0')} AS INTEGER) AS weather_delay,
    CAST({_share('h % 5 IN (1, 2)')} AS INTEGER) AS nas_delay,
    CAST({_share('h % 5 = 3')} AS INTEGER) AS security_delay,
    CAST({_share('h % 5 = 4')} AS INTEGER) AS late_aircraft_delay
  FROM fx_c f
  JOIN nation no ON no.n_nationkey = f.cn JOIN region ro ON ro.r_regionkey = no.n_regionkey
  JOIN nation nd ON nd.n_nationkey = f.sn JOIN region rd ON rd.r_regionkey = nd.n_regionkey
),
flights_raw AS (
  SELECT * EXCLUDE (l_orderkey) FROM fx_one
  UNION ALL
  SELECT * EXCLUDE (l_orderkey) FROM fx_one WHERE l_orderkey % 50 = 0
)"""

FLIGHTS_CLEAN = """
fx_dedup AS (
  SELECT DISTINCT * REPLACE (CAST(try_strptime(fl_date, '%Y-%m-%d') AS DATE) AS fl_date)
  FROM flights_raw
),
flights_clean AS (
  SELECT * FROM fx_dedup
  WHERE cancelled = 0 AND diverted = 0
    AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL
    AND dep_delay BETWEEN -120 AND 1440 AND arr_delay BETWEEN -120 AND 1440
)"""


def _case(col: str, bounds, labels, first_inclusive=False) -> str:
    parts = []
    for i, (b, lab) in enumerate(zip(bounds, labels)):
        op = "<=" if (i == 0 and first_inclusive) else "<"
        parts.append(f"WHEN {col} {op} {b} THEN '{lab}'")
    return "CASE " + " ".join(parts) + f" ELSE '{labels[-1]}' END"


FLIGHTS_FEATURED = f"""
fx_f1 AS (
  SELECT *,
    CAST(arr_delay >= 15 AS INTEGER) AS is_delayed,
    CAST(arr_delay < 0 AS INTEGER) AS is_early,
    CAST(arr_delay < 15 AS INTEGER) AS is_on_time,
    CAST(arr_delay >= 60 AS INTEGER) AS is_big_delay,
    dep_delay - arr_delay AS made_up_time,
    {_case('arr_delay', [0, 15, 60, 180], ['Early', 'On time', 'Minor (15-60m)', 'Major (1-3h)', 'Severe (3h+)'])} AS delay_band,
    CAST(trunc(crs_dep_time / 100) AS INTEGER) AS dep_hour
  FROM flights_clean
),
flights_featured AS (
  SELECT *,
    {_case('dep_hour', [6, 12, 17, 21], ['Night (0-6)', 'Morning (6-12)', 'Afternoon (12-17)', 'Evening (17-21)', 'Late (21-24)'])} AS day_part,
    CAST(dep_hour >= 22 OR dep_hour <= 5 AS INTEGER) AS is_redeye,
    CAST(day_of_week IN (6, 7) AS INTEGER) AS is_weekend,
    CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
         WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
    CASE day_of_week WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu'
         WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' ELSE 'Sun' END AS dow_name,
    concat_ws('-', origin, dest) AS route,
    {_case('distance', [250, 600, 1200, 2500], ['Very short (<250mi)', 'Short (250-600)', 'Medium (600-1200)', 'Long (1200-2500)', 'Very long (2500+)'])} AS distance_band,
    CAST(distance >= 1200 AS INTEGER) AS is_longhaul,
    {', '.join(f'CAST({c} > 0 AS INTEGER) AS has_{c}' for c in CAUSES)}
  FROM fx_f1
)"""

# Derived dimensions (FIXTURES §3): coordinates for nations 0-21, state codes
# for every nation key not congruent to 7 mod 8.
DIMS = """
coords AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS name,
         CAST(25 + n_nationkey AS DOUBLE) AS lat, CAST(-70 - 2 * n_nationkey AS DOUBLE) AS lon
  FROM nation WHERE n_nationkey <= 21
),
state_codes AS (
  SELECT n_name AS state, 'S' || CAST(n_nationkey AS VARCHAR) AS code
  FROM nation WHERE n_nationkey % 8 <> 7
)"""


def with_raw(select: str) -> str:
    return f"WITH {FLIGHTS_RAW}\n{select}"


def with_clean(select: str) -> str:
    return f"WITH {FLIGHTS_RAW},{FLIGHTS_CLEAN}\n{select}"


def with_featured(select: str, dims: bool = False, ctes: str = "") -> str:
    extra = f",{DIMS}" if dims else ""
    more = f",\n{ctes}" if ctes else ""
    return f"WITH {FLIGHTS_RAW},{FLIGHTS_CLEAN},{FLIGHTS_FEATURED}{extra}{more}\n{select}"


SUMMARY = f"""count(*) AS flights,
  {r('avg(arr_delay)', 2)} AS avg_arr_delay,
  {r('avg(dep_delay)', 2)} AS avg_dep_delay,
  {r('100 * avg(is_delayed)', 2)} AS delayed_pct,
  {r('100 * avg(is_big_delay)', 2)} AS big_delay_pct,
  {r('100 * avg(is_early)', 2)} AS early_pct"""


def summary_by(key: str, min_flights: int = 0, extra: str = "") -> str:
    having = f" HAVING count(*) >= {min_flights}" if min_flights else ""
    return with_featured(
        f"SELECT {key}, {SUMMARY}{extra} FROM flights_featured GROUP BY {key}{having}")


# The reported percentile points.
PERCENTILES = {"P10": 0.10, "P25": 0.25, "P50": 0.50, "P75": 0.75, "P90": 0.90, "P95": 0.95, "P99": 0.99}

# --- segments ---------------------------------------------------------------------

_MEANS = ["avg_arr_delay", "delayed_pct", "avg_taxi_out", "pct_longhaul"]
PROFILES = f"""
profiles AS (
  SELECT * FROM (SELECT origin, count(*) AS flights, {r('avg(arr_delay)', 2)} AS avg_arr_delay,
    {r('100 * avg(is_delayed)', 2)} AS delayed_pct, {r('avg(taxi_out)', 2)} AS avg_taxi_out,
    {r('100 * avg(is_longhaul)', 2)} AS pct_longhaul FROM flights_featured GROUP BY origin)
  WHERE flights >= CASE WHEN (SELECT count(*) FROM flights_featured) > 20000 THEN 1000 ELSE 50 END
    AND origin IS NOT NULL AND {' AND '.join(f'{m} IS NOT NULL' for m in _MEANS)}
)"""


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"


def _segments(most: int, sweep: str) -> str:
    """Standardised profiles; the picked start; 20 rounds of K-Means for each k of the sweep."""
    scaled = ", ".join(f"(CAST({m} AS DOUBLE) - avg({m}) OVER ()) / stddev_samp({m}) OVER ()" for m in ["flights", *_MEANS])
    steps = [PROFILES, f"z AS MATERIALIZED (SELECT origin, flights, [{scaled}] AS v FROM profiles)",
             "t1 AS MATERIALIZED (SELECT 0 AS c, v FROM z ORDER BY flights DESC, origin LIMIT 1)"]
    for i in range(1, most):
        steps.append(f"""t{i + 1} AS MATERIALIZED (SELECT * FROM t{i} UNION ALL SELECT {i}, v FROM (
  SELECT z.origin, any_value(z.v) AS v, min({_distance('z.v', f't{i}.v')}) AS d FROM z, t{i} GROUP BY z.origin
  ORDER BY d DESC, z.origin LIMIT 1))""")
    steps.append(f"""m0 AS MATERIALIZED (SELECT k, t.c, t.v FROM t{most} t, (SELECT unnest({sweep}) AS k) ks
  WHERE t.c < k AND k < (SELECT count(*) FROM z))""")
    for i in range(21):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT m.k, z.origin, z.v, m.c FROM z, m{i} m
  QUALIFY row_number() OVER (PARTITION BY m.k, z.origin ORDER BY {_distance('z.v', 'm.v')}, m.c) = 1)""")
        if i < 20:
            steps.append(f"""m{i + 1} AS MATERIALIZED (SELECT k, c, coalesce(w, m{i}.v) AS v FROM m{i} LEFT JOIN (
  SELECT k, c, list(x ORDER BY j) AS w FROM (SELECT k, c, j, avg(v[j]) AS x FROM a{i}, (SELECT unnest([1, 2, 3, 4, 5]) AS j) GROUP BY k, c, j)
  GROUP BY k, c) USING (k, c))""")
    return ",\n".join(steps)


def k_sweep() -> str:
    pair = f"""pairs AS (SELECT a.k, a.origin, a.c AS own, b.c AS other, sum({_distance('a.v', 'b.v')}) AS d, count(*) AS n
  FROM a20 a JOIN a20 b USING (k) GROUP BY a.k, a.origin, a.c, b.c),
ab AS (SELECT k, origin, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN d / n END) AS b FROM pairs GROUP BY k, origin)"""
    return with_featured(f"SELECT CAST(k AS INTEGER) AS k, {r('avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)', 4)} AS silhouette "
                         "FROM ab GROUP BY k", ctes=f"{_segments(6, '[2, 3, 4, 5, 6]')},\n{pair}")


def _four() -> str:
    return _segments(4, "[least(4, (SELECT count(*) - 1 FROM z))]")


def airport_segments() -> str:
    return with_featured("SELECT p.*, CAST(a20.c AS INTEGER) AS cluster FROM profiles p JOIN a20 USING (origin)", ctes=_four())


def segment_profiles() -> str:
    means = ", ".join(f"{r(f'avg({m})', 2)} AS {m}" for m in ["flights", *_MEANS])
    return with_featured(f"SELECT CAST(c AS INTEGER) AS cluster, {means}, count(*) AS n_airports FROM profiles JOIN a20 USING (origin) GROUP BY c",
                         ctes=_four())


# --- models -----------------------------------------------------------------------

_CATEGORIES = ["op_unique_carrier", "origin", "dest", "season", "day_part"]
_NUMBERS = ["month", "day_of_week", "dep_hour", "distance", "is_weekend", "is_redeye"]
_IDENTITY = ("strftime(fl_date, '%Y-%m-%d'), op_unique_carrier, CAST(CAST(op_carrier_fl_num AS BIGINT) AS VARCHAR), origin, dest, "
             "CAST(crs_dep_time AS VARCHAR)")


def draw(salt: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{salt}', {_IDENTITY})), 1, 8) AS BIGINT) / 4294967296.0"


MODEL_ROWS = f"""
model_rows AS (
  SELECT {', '.join([*_CATEGORIES, *_NUMBERS])}, is_delayed, arr_delay,
    {draw('split-42')} AS draw, {draw('sample-42')} AS sample
  FROM flights_featured WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*_CATEGORIES, *_NUMBERS, 'is_delayed', 'arr_delay'])}
)"""


def with_model_rows(select: str, ctes: str = "") -> str:
    return with_featured(select, ctes=f"{MODEL_ROWS},\n{ctes}" if ctes else MODEL_ROWS)


def feature_slots() -> str:
    values = " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS source, {c} AS value, count(*) AS n FROM model_rows WHERE draw < 0.8 GROUP BY {c}"
                                for i, c in enumerate(_CATEGORIES))
    numbers = " UNION ALL ".join(f"SELECT CAST((SELECT count(*) FROM counted) + {i} AS BIGINT), '{c}', NULL, NULL" for i, c in enumerate(_NUMBERS))
    return with_model_rows(
        "SELECT CAST(row_number() OVER (ORDER BY place, n DESC, value) - 1 AS BIGINT) AS slot, source, value, n AS rows FROM counted "
        f"UNION ALL {numbers}", f"counted AS ({values})")


_RATES = """base AS (SELECT avg(CAST(is_delayed AS DOUBLE)) AS b FROM model_rows WHERE draw < 0.8),
rates AS (SELECT op_unique_carrier, dep_hour, (sum(is_delayed) + 20.0 * any_value(b)) / (count(*) + 20.0) AS rate
  FROM model_rows, base WHERE draw < 0.8 GROUP BY op_unique_carrier, dep_hour),
scored AS (SELECT is_delayed AS label, coalesce(rate, b) AS score, CASE WHEN coalesce(rate, b) > b THEN 1 ELSE 0 END AS prediction
  FROM base, model_rows m LEFT JOIN rates USING (op_unique_carrier, dep_hour) WHERE m.draw >= 0.8)"""


def rate_confusion() -> str:
    return with_model_rows(
        "SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n, "
        "CASE WHEN label = prediction THEN 'T' ELSE 'F' END || CASE WHEN prediction = 1 THEN 'P' ELSE 'N' END AS outcome "
        "FROM scored GROUP BY label, prediction", _RATES)


def mean_metrics() -> str:
    return with_model_rows(
        f"SELECT 'RMSE' AS metric, {r('sqrt(avg((y - p) * (y - p)))', 3)} AS value FROM scored "
        f"UNION ALL SELECT 'MAE', {r('avg(abs(y - p))', 3)} FROM scored "
        f"UNION ALL SELECT 'R2', {r('1 - (SELECT sum((y - p) * (y - p)) FROM scored) / sum((y - m) * (y - m))', 4)} "
        "FROM scored, (SELECT avg(y) AS m FROM scored)",
        """base AS (SELECT avg(arr_delay) AS b FROM model_rows WHERE draw < 0.8),
rates AS (SELECT op_unique_carrier, dep_hour, (sum(arr_delay) + 20.0 * any_value(b)) / (count(*) + 20.0) AS rate
  FROM model_rows, base WHERE draw < 0.8 GROUP BY op_unique_carrier, dep_hour),
scored AS (SELECT arr_delay AS y, coalesce(rate, b) AS p FROM base, model_rows m LEFT JOIN rates USING (op_unique_carrier, dep_hour)
  WHERE m.draw >= 0.8)""")


def rate_metrics() -> str:
    # AUC from mean ranks of the positive rows, F1 from precision and recall
    ranks = f"""ranks AS (SELECT label, prediction, rank() OVER (ORDER BY {r('score', 6)}) + (count(*) OVER (PARTITION BY {r('score', 6)}) - 1) / 2.0 AS rank
  FROM scored),
n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q, sum(rank) FILTER (label = 1) AS s,
  count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM ranks),
f AS (SELECT *, tp + (q - tn) AS called_p, tn + (p - tp) AS called_q FROM n)"""
    score = "(p * coalesce(2.0 * tp / (p + called_p), 0) + q * coalesce(2.0 * tn / (q + called_q), 0)) / (p + q)"
    return with_model_rows(
        f"SELECT 'AUC' AS metric, {r('(s - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * q)', 4)} AS value FROM f "
        f"UNION ALL SELECT 'accuracy', {r('CAST(tp + tn AS DOUBLE) / (p + q)', 4)} FROM f UNION ALL SELECT 'f1', {r(score, 4)} FROM f",
        f"{_RATES},\n{ranks}")


# --- breakdowns -------------------------------------------------------------------

# The dimensions and their key columns, row thresholds and the names of flags.
DIMENSIONS = {"airline": "op_unique_carrier", "origin": "origin", "dest": "dest", "route": "route", "month": "month",
              "weekday": "day_of_week", "hour": "dep_hour", "season": "season", "day_part": "day_part",
              "distance_band": "distance_band", "weekend": "is_weekend", "state": "origin_state_nm", "redeye": "is_redeye"}
LEAST_FLIGHTS = {"origin": 200, "dest": 200, "route": 100}
KINDS = {"weekend": ", CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS kind",
         "redeye": ", CASE WHEN is_redeye = 1 THEN 'Red-eye' ELSE 'Daytime' END AS kind"}
CORRELATED = ["dep_delay", "arr_delay", "taxi_out", "taxi_in", "distance", "air_time", "crs_elapsed_time", "dep_hour"]
DESCRIBED = ["dep_delay", "arr_delay", "distance", "air_time", "taxi_out"]


def all_breakdowns(least: dict[str, int]) -> str:
    return with_featured(" UNION ALL ".join(
        f"SELECT '{name}' AS dimension, CAST({column} AS VARCHAR) AS key, {SUMMARY} FROM flights_featured GROUP BY {column}"
        + (f" HAVING count(*) >= {least[name]}" if name in least else "") for name, column in DIMENSIONS.items()))
