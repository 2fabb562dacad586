"""Named queries over the test-data folders, each paired with its oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. The flight tables are derived
from the folder's star-schema tables once per application and written as
Parquet (raw rows and distinct rows with copy counts, ``tarmac.sources.store``);
cleaned and featured tables are views over them. Every query runs its operator
over the whole table; the SQL next to it is the independent DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import distribution as D
from tarmac.operators import evaluate as E
from tarmac.operators import network as N
from tarmac.operators import predict as P
from tarmac.operators import quality as Q
from tarmac.operators import relate as R
from tarmac.operators import score as SC
from tarmac.operators import segment as G
from tarmac.operators import summarize as S
from tarmac.plans import oracle as O
from tarmac.schema import CAUSES, FLIGHT_COLUMNS
from tarmac.sources.dims import coords_for, read_dimension, state_codes_for
from tarmac.sources.flights import load_flights, rejected_cells as load_rejects, save_table
from tarmac.sources.star import STAR_TABLES
from tarmac.sources.store import FlightTables, flight_files, flight_tables, stored, stored_path, wide_job

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def raw(spark, sf_dir):
    return flight_tables(spark, sf_dir).raw


def clean(spark, sf_dir):
    return flight_tables(spark, sf_dir).clean


def featured(spark, sf_dir):
    return flight_tables(spark, sf_dir).featured


# --- base tables (IO1, CL1-CL6, FE1-FE17) ---------------------------------

@query("flights_base", O.with_raw("SELECT * FROM flights_raw"))
def q_flights_base(spark, sf_dir):
    return raw(spark, sf_dir)


@query("flights_clean", O.with_clean("SELECT * FROM flights_clean"))
def q_flights_clean(spark, sf_dir):
    return clean(spark, sf_dir)


@query("flights_featured", O.with_featured("SELECT * FROM flights_featured"))
def q_flights_featured(spark, sf_dir):
    return featured(spark, sf_dir)


# --- quality reports (IO7, CL7-CL11, WN1) ----------------------------------

@query("table_profile", O.with_raw(
    f"SELECT count(*) AS rows, CAST({len(FLIGHT_COLUMNS)} AS INTEGER) AS columns FROM flights_raw"))
def q_table_profile(spark, sf_dir):
    return Q.table_profile(raw(spark, sf_dir))


_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in FLIGHT_COLUMNS)


@query("null_profile", O.with_raw(
    f"SELECT column_name, null_count FROM (SELECT {_NULLS} FROM flights_raw) "
    f"UNPIVOT (null_count FOR column_name IN ({', '.join(FLIGHT_COLUMNS)}))"))
def q_null_profile(spark, sf_dir):
    return Q.missing_value_long(raw(spark, sf_dir))


@query("duplicate_stats", O.with_raw(
    "SELECT t.total_rows, d.distinct_rows, t.total_rows - d.distinct_rows AS duplicate_rows "
    "FROM (SELECT count(*) AS total_rows FROM flights_raw) t, "
    "(SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM flights_raw)) d"))
def q_duplicate_stats(spark, sf_dir):
    t = flight_tables(spark, sf_dir)
    return Q.duplicate_stats(t.raw_once, distinct=t.distinct)


_STEP_SQL = [
    ("start", "SELECT count(*) FROM flights_raw"),
    ("parse dates", "SELECT count(*) FROM flights_raw"),
    ("drop duplicates", "SELECT count(*) FROM fx_dedup"),
    ("drop cancelled/diverted", "SELECT count(*) FROM fx_dedup WHERE cancelled = 0 AND diverted = 0"),
    ("drop missing delays", "SELECT count(*) FROM fx_dedup WHERE cancelled = 0 AND diverted = 0 "
                            "AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL"),
    ("remove outliers", "SELECT count(*) FROM flights_clean"),
]
_STEPS = " UNION ALL ".join(
    f"SELECT {i} AS step_no, '{name}' AS step, ({sql}) AS rows"
    for i, (name, sql) in enumerate(_STEP_SQL))


@query("cleaning_waterfall", O.with_clean(
    f"SELECT step_no, step, rows, lag(rows) OVER (ORDER BY step_no) - rows AS removed "
    f"FROM ({_STEPS})"))
def q_cleaning_waterfall(spark, sf_dir):
    t = flight_tables(spark, sf_dir)
    return Q.cleaning_waterfall(t.raw_once, distinct=t.distinct)


_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {O.r(f'avg({c})', 4)} AS mean, "
    f"{O.r_stable(f'stddev_samp({c})', 4)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM flights_raw"
    for c in O.DESCRIBED)


@query("numeric_summary", O.with_raw(_DESCRIBE))
def q_numeric_summary(spark, sf_dir):
    return Q.numeric_summary(raw(spark, sf_dir))


# --- delay breakdowns (AG0, AN1-AN12, AN14, AG1) ---------------------------

for _name, _column in O.DIMENSIONS.items():
    _least = O.LEAST_FLIGHTS.get(_name, 0)
    QUERIES[f"delay_by_{_name}"] = lambda spark, sf_dir, name=_name, least=_least: S.breakdown(featured(spark, sf_dir), name, least)
    ORACLE[f"delay_by_{_name}"] = O.summary_by(_column, _least, O.KINDS.get(_name, ""))


@query("delay_all_dimensions", O.all_breakdowns({}))
def q_delay_all_dimensions(spark, sf_dir):
    return S.all_breakdowns(featured(spark, sf_dir))


# --- bands and causes (AN13, AN15-AN18, WN2, WN3) --------------------------

@query("delay_bands", O.with_featured(
    f"SELECT delay_band, flights, {O.r('100 * flights / sum(flights) OVER ()', 2)} AS share_pct "
    f"FROM (SELECT delay_band, count(*) AS flights FROM flights_featured GROUP BY delay_band)"))
def q_delay_bands(spark, sf_dir):
    return S.band_counts(featured(spark, sf_dir))


_CAUSE_ROWS = " UNION ALL ".join(
    f"SELECT {i + 1} AS cause_no, '{c}' AS cause, CAST(sum({c}) AS BIGINT) AS minutes "
    f"FROM flights_featured" for i, c in enumerate(CAUSES))


@query("cause_totals", O.with_featured(
    f"SELECT cause_no, cause, minutes, "
    f"{O.r('100 * minutes / sum(minutes) OVER ()', 2)} AS share_pct FROM ({_CAUSE_ROWS})"))
def q_cause_totals(spark, sf_dir):
    long = S.causes_long(S.per_cause(featured(spark, sf_dir), S.minutes), "minutes")
    return long.withColumn("share_pct", S.share_of_total("minutes"))


@query("cause_frequency", O.with_featured(" UNION ALL ".join(
    f"SELECT {i + 1} AS cause_no, '{c}' AS cause, {O.r(f'100 * avg(has_{c})', 2)} "
    f"AS pct_of_flights FROM flights_featured" for i, c in enumerate(CAUSES))))
def q_cause_frequency(spark, sf_dir):
    return S.causes_long(S.per_cause(featured(spark, sf_dir), S.share_of_recorded), "pct_of_flights")


_CAUSE_MONTH = " UNION ALL ".join(
    f"SELECT month, {i + 1} AS cause_no, '{c}' AS cause, CAST(sum({c}) AS BIGINT) AS minutes "
    f"FROM flights_featured GROUP BY month" for i, c in enumerate(CAUSES))


@query("cause_by_month", O.with_featured(
    "SELECT month, cause_no, cause, minutes, CAST(COALESCE(sum(minutes) OVER ("
    "PARTITION BY month ORDER BY cause_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    f"AS BIGINT) AS stack_base FROM ({_CAUSE_MONTH})"))
def q_cause_by_month(spark, sf_dir):
    wide = S.per_cause(featured(spark, sf_dir), S.minutes, ["month"])
    return S.stacked(S.causes_long(wide, "minutes", ["month"]), "minutes", ["month"])


# --- cancellations on raw rows (AN19-AN22) ---------------------------------

@query("cancel_overview", O.with_raw(
    f"SELECT count(*) AS total_flights, {O.r('100 * avg(cancelled)', 3)} AS cancelled_pct, "
    f"{O.r('100 * avg(diverted)', 3)} AS diverted_pct FROM flights_raw"))
def q_cancel_overview(spark, sf_dir):
    return S.rates(raw(spark, sf_dir), count="total_flights")


@query("cancel_by_reason", O.with_raw(
    "SELECT cancellation_code, count(*) AS cancellations FROM flights_raw "
    "WHERE cancelled = 1 GROUP BY cancellation_code"))
def q_cancel_by_reason(spark, sf_dir):
    return S.counts_where(raw(spark, sf_dir), "cancelled", "cancellation_code", "cancellations")


@query("cancel_by_airline", O.with_raw(
    f"SELECT op_unique_carrier, count(*) AS flights, {O.r('100 * avg(cancelled)', 3)} "
    f"AS cancelled_pct, {O.r('100 * avg(diverted)', 3)} AS diverted_pct FROM flights_raw "
    "GROUP BY op_unique_carrier"))
def q_cancel_by_airline(spark, sf_dir):
    return S.rates(raw(spark, sf_dir), ["op_unique_carrier"], worst_first=True)


@query("cancel_by_month", O.with_raw(
    f"SELECT month, {O.r('100 * avg(cancelled)', 3)} AS cancelled_pct FROM flights_raw "
    "GROUP BY month"))
def q_cancel_by_month(spark, sf_dir):
    return S.rates(raw(spark, sf_dir), ["month"], {"cancelled_pct": "cancelled"}, count=None)


# --- distributions (AD1-AD4, VZ1) ------------------------------------------


@query("arr_delay_stats", O.with_featured(
    f"SELECT count(arr_delay) AS count, {O.r('avg(arr_delay)', 2)} AS mean, "
    f"{O.r_stable('stddev_samp(arr_delay)', 2)} AS stddev, min(arr_delay) AS min, "
    "max(arr_delay) AS max FROM flights_featured"))
def q_arr_delay_stats(spark, sf_dir):
    return D.value_summary(featured(spark, sf_dir))


@query("arr_delay_percentiles", O.with_featured(" UNION ALL ".join(
    f"SELECT '{lab}' AS percentile, CAST(quantile_disc(arr_delay, {p}) AS DOUBLE) AS minutes "
    f"FROM flights_featured" for lab, p in O.PERCENTILES.items())))
def q_arr_delay_percentiles(spark, sf_dir):
    return D.percentiles(featured(spark, sf_dir))


@query("arr_delay_histogram", O.with_featured(
    "SELECT bin, count(*) AS flights FROM (SELECT CAST(floor(arr_delay / 15) * 15 AS INTEGER) "
    "AS bin FROM flights_featured) WHERE bin BETWEEN -60 AND 240 GROUP BY bin"))
def q_arr_delay_histogram(spark, sf_dir):
    return D.binned_counts(featured(spark, sf_dir))


@query("airline_percentiles", O.with_featured(
    f"SELECT op_unique_carrier, count(*) AS flights, "
    f"{O.r('quantile_disc(arr_delay, 0.5)', 1)} AS median_delay, "
    f"{O.r('quantile_disc(arr_delay, 0.9)', 1)} AS p90_delay FROM flights_featured "
    "GROUP BY op_unique_carrier HAVING count(*) >= 1000"))
def q_airline_percentiles(spark, sf_dir):
    return D.group_percentiles(featured(spark, sf_dir), min_flights=1000)


def _box_sql(group: str) -> str:
    fence = "v.arr_delay BETWEEN st.q1 - 1.5 * (st.q3 - st.q1) AND st.q3 + 1.5 * (st.q3 - st.q1)"
    return O.with_featured(
        f"SELECT st.g AS {group}, st.n, {O.r('st.q1', 4)} AS q1, {O.r('st.median', 4)} AS median, {O.r('st.q3', 4)} AS q3, "
        f"CAST(min(v.arr_delay) FILTER (WHERE {fence}) AS DOUBLE) AS lower_whisker, "
        f"CAST(max(v.arr_delay) FILTER (WHERE {fence}) AS DOUBLE) AS upper_whisker, "
        f"count(*) FILTER (WHERE NOT ({fence})) AS n_outliers "
        "FROM st JOIN bx_vals v ON v.g = st.g GROUP BY st.g, st.n, st.q1, st.median, st.q3",
        ctes=f"""bx_top AS (SELECT {group} AS g, count(*) AS c FROM flights_featured WHERE {group} IS NOT NULL
                GROUP BY {group} ORDER BY c DESC, {group} LIMIT 12),
bx_vals AS (SELECT t.g, f.arr_delay FROM flights_featured f JOIN bx_top t ON f.{group} = t.g WHERE f.arr_delay IS NOT NULL),
st AS (SELECT g, count(*) AS n, quantile_cont(arr_delay, 0.25) AS q1, quantile_cont(arr_delay, 0.5) AS median,
              quantile_cont(arr_delay, 0.75) AS q3 FROM bx_vals GROUP BY g)""")


@query("box_by_season", _box_sql("season"))
def q_box_by_season(spark, sf_dir):
    return D.box_stats(featured(spark, sf_dir), "season", "arr_delay")


@query("box_by_hour", _box_sql("dep_hour"))
def q_box_by_hour(spark, sf_dir):
    """25 hours: the cut of 12 groups bites."""
    return D.box_stats(featured(spark, sf_dir), "dep_hour", "arr_delay")


@query("frequent_routes", O.with_featured(
    "SELECT route, count(*) AS rows FROM flights_featured WHERE route IS NOT NULL GROUP BY route ORDER BY rows DESC, route LIMIT 12"))
def q_frequent_routes(spark, sf_dir):
    return SC.top_groups(featured(spark, sf_dir), "route")


# --- relationships (AD5, AD7-AD9) -------------------------------------------

_CD = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in O.CORRELATED)
_CD_WHERE = " AND ".join(f"{c} IS NOT NULL" for c in O.CORRELATED)
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {O.r_stable(f'corr({a}, {b})', 6)} AS corr FROM cd"
    for a in O.CORRELATED for b in O.CORRELATED)


@query("correlations", O.with_featured(
    _CORR, ctes=f"cd AS (SELECT {_CD} FROM flights_featured WHERE {_CD_WHERE})"))
def q_correlations(spark, sf_dir):
    return R.correlation_long(featured(spark, sf_dir))


_DEP_BAND = O._case("dep_delay", [0, 15, 30, 60, 120],
                    ["On time / early", "1-15 late", "15-30 late", "30-60 late", "60-120 late",
                     "120+ late"], first_inclusive=True)


@query("recovery_by_band", O.with_featured(
    f"SELECT dep_band, count(*) AS flights, {O.r('avg(dep_delay)', 1)} AS avg_dep_delay, "
    f"{O.r('avg(arr_delay)', 1)} AS avg_arr_delay, "
    f"{O.r('avg(made_up_time)', 1)} AS avg_minutes_recovered "
    f"FROM (SELECT *, {_DEP_BAND} AS dep_band FROM flights_featured) GROUP BY dep_band"))
def q_recovery_by_band(spark, sf_dir):
    return R.propagation_by_dep_band(featured(spark, sf_dir))


def _heat_sql(rows, cols, values, prefix):
    cells = ", ".join(
        f"{O.r(f'avg(arr_delay) FILTER (WHERE {cols} = {v})', 2)} AS {prefix}{v}" for v in values)
    return O.with_featured(f"SELECT {rows}, {cells} FROM flights_featured GROUP BY {rows}")


@query("heat_hour_weekday", _heat_sql("dep_hour", "day_of_week", range(1, 8), "dow"))
def q_heat_hour_weekday(spark, sf_dir):
    return R.heatmap_hour_vs_dow(featured(spark, sf_dir))


@query("heat_airline_month", _heat_sql("op_unique_carrier", "month", range(1, 13), "m"))
def q_heat_airline_month(spark, sf_dir):
    return R.heatmap_airline_vs_month(featured(spark, sf_dir))


# --- network and maps (AD10, AD11, ST1, JN1-JN4, VZ3-VZ5) -------------------

@query("airport_traffic", O.with_featured(
    "SELECT COALESCE(d.airport, a.airport) AS airport, COALESCE(d.departures, 0) AS departures, "
    "COALESCE(a.arrivals, 0) AS arrivals, "
    "COALESCE(d.departures, 0) + COALESCE(a.arrivals, 0) AS total_movements "
    "FROM (SELECT origin AS airport, count(*) AS departures FROM flights_featured GROUP BY origin) d "
    "FULL OUTER JOIN (SELECT dest AS airport, count(*) AS arrivals FROM flights_featured "
    "GROUP BY dest) a ON d.airport = a.airport "
    "ORDER BY total_movements DESC, airport LIMIT 20"))
def q_airport_traffic(spark, sf_dir):
    return N.airport_traffic(featured(spark, sf_dir), top=20)


_BUSIEST = (f"SELECT origin, dest, route, count(*) AS flights, {O.r('avg(arr_delay)', 2)} "
            "AS avg_arr_delay, min(distance) AS distance FROM flights_featured "
            "GROUP BY origin, dest, route ORDER BY flights DESC, route, origin, dest LIMIT 25")


@query("busiest_routes", O.with_featured(_BUSIEST))
def q_busiest_routes(spark, sf_dir):
    return N.busiest_routes(featured(spark, sf_dir), top=25)


@query("route_nodes", O.with_featured(
    "SELECT n.airport, c.name AS airport_name, c.lat, c.lon FROM "
    "(SELECT origin AS airport FROM br UNION SELECT dest FROM br) n "
    "JOIN coords c ON c.code = n.airport", dims=True, ctes=f"br AS ({_BUSIEST})"))
def q_route_nodes(spark, sf_dir):
    routes = N.busiest_routes(featured(spark, sf_dir), top=25)
    return N.route_nodes(routes, coords_for(spark, sf_dir))


@query("route_edges_geo", O.with_featured(
    "SELECT b.origin, b.dest, b.route, b.flights, "
    f"{O.r('1 + 6 * b.flights / max(b.flights) OVER ()', 4)} AS width, "
    "o.lat AS origin_lat, o.lon AS origin_lon, d.lat AS dest_lat, d.lon AS dest_lon "
    "FROM br b "
    "JOIN coords o ON o.code = b.origin JOIN coords d ON d.code = b.dest",
    dims=True, ctes=f"br AS ({_BUSIEST})"))
def q_route_edges_geo(spark, sf_dir):
    routes = N.busiest_routes(featured(spark, sf_dir), top=25)
    return N.route_edges(routes, coords_for(spark, sf_dir))


@query("airport_bubbles", O.with_featured(
    f"SELECT a.origin, a.flights, a.avg_arr_delay, c.name AS airport_name, c.lat, c.lon FROM "
    f"(SELECT origin, count(*) AS flights, {O.r('avg(arr_delay)', 2)} AS avg_arr_delay "
    "FROM flights_featured GROUP BY origin HAVING count(*) >= 200) a "
    "JOIN coords c ON c.code = a.origin", dims=True))
def q_airport_bubbles(spark, sf_dir):
    return N.airport_bubbles(featured(spark, sf_dir), coords_for(spark, sf_dir), min_flights=200)


@query("state_values", O.with_featured(
    f"SELECT s.state, s.code, a.value FROM (SELECT origin_state_nm, "
    f"{O.r('avg(arr_delay)', 2)} AS value FROM flights_featured GROUP BY origin_state_nm) a "
    "JOIN state_codes s ON s.state = a.origin_state_nm", dims=True))
def q_state_values(spark, sf_dir):
    return N.state_values(featured(spark, sf_dir), state_codes_for(spark, sf_dir))


# --- scorecards and rankings (TK3, AD12, VZ2, VZ6) -------------------------

@query("worst_destinations", O.with_featured(
    f"SELECT dest, {O.SUMMARY} FROM flights_featured GROUP BY dest HAVING count(*) >= 200 "
    "ORDER BY avg_arr_delay DESC, dest LIMIT 15"))
def q_worst_destinations(spark, sf_dir):
    by_dest = S.breakdown(featured(spark, sf_dir), "dest", 200)
    return SC.top_rows(by_dest, 15, F.desc("avg_arr_delay"), "dest")


_SCORE = (f"SELECT op_unique_carrier, count(*) AS flights, "
          f"{O.r('100 * avg(is_on_time)', 1)} AS on_time_pct, "
          f"{O.r('avg(arr_delay)', 1)} AS avg_arr_delay, "
          f"{O.r('quantile_disc(arr_delay, 0.9)', 1)} AS p90_delay, "
          f"{O.r('100 * avg(is_big_delay)', 2)} AS big_delay_pct "
          "FROM flights_featured GROUP BY op_unique_carrier HAVING count(*) >= 1000")


@query("airline_score", O.with_featured(_SCORE))
def q_airline_score(spark, sf_dir):
    return SC.scorecard(featured(spark, sf_dir), min_flights=1000)


_RADAR_METRICS = ["on_time_pct", "avg_arr_delay", "p90_delay", "big_delay_pct"]
_RADAR = ", ".join(
    f"CASE WHEN max({m}) OVER () = min({m}) OVER () THEN 0.5 ELSE "
    f"{O.r(f'({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER ())', 4)} END AS {m}"
    for m in _RADAR_METRICS)


@query("airline_radar", O.with_featured(
    f"SELECT op_unique_carrier, {_RADAR} FROM "
    "(SELECT * FROM sc ORDER BY on_time_pct DESC, op_unique_carrier LIMIT 5)",
    ctes=f"sc AS ({_SCORE})"))
def q_airline_radar(spark, sf_dir):
    score = SC.scorecard(featured(spark, sf_dir), min_flights=1000)
    return SC.normalise_top(score, "op_unique_carrier", _RADAR_METRICS,
                            [F.desc("on_time_pct"), "op_unique_carrier"], top=5)


@query("airline_dep_vs_arr", O.with_featured(
    "SELECT op_unique_carrier, 'dep' AS series, avg_dep_delay AS minutes FROM top12 "
    "UNION ALL SELECT op_unique_carrier, 'arr' AS series, avg_arr_delay AS minutes FROM top12",
    ctes=f"top12 AS (SELECT op_unique_carrier, {O.SUMMARY} FROM flights_featured "
         "GROUP BY op_unique_carrier ORDER BY flights DESC, op_unique_carrier LIMIT 12)"))
def q_airline_dep_vs_arr(spark, sf_dir):
    by_airline = S.breakdown(featured(spark, sf_dir), "airline")
    top = SC.top_rows(by_airline, 12, F.desc("flights"), "op_unique_carrier")
    return SC.series_long(top, "op_unique_carrier",
                          {"dep": "avg_dep_delay", "arr": "avg_arr_delay"}, "minutes")


# --- segmentation (CU1-CU6) ------------------------------------------------


@query("airport_profiles", O.with_featured("SELECT * FROM profiles", ctes=O.PROFILES))
def q_airport_profiles(spark, sf_dir):
    return G.profiles(featured(spark, sf_dir))


@query("k_sweep", O.k_sweep())
def q_k_sweep(spark, sf_dir):
    return G.silhouettes(G.profiles(featured(spark, sf_dir)))


@query("airport_segments", O.airport_segments())
def q_airport_segments(spark, sf_dir):
    return G.segments(G.profiles(featured(spark, sf_dir)))


@query("segment_profiles", O.segment_profiles())
def q_segment_profiles(spark, sf_dir):
    return G.segment_means(G.segments(G.profiles(featured(spark, sf_dir))))


# --- sampling (AD6) ----------------------------------------------------------

@query("delay_scatter_sample", O.with_featured(
    "SELECT dep_delay, arr_delay FROM flights_featured ORDER BY md5(concat_ws('|', '42', "
    "strftime(fl_date, '%Y-%m-%d'), op_unique_carrier, CAST(CAST(op_carrier_fl_num AS BIGINT) AS VARCHAR), "
    "origin, dest, CAST(crs_dep_time AS VARCHAR))), dep_delay, arr_delay LIMIT 5000"))
def q_delay_scatter_sample(spark, sf_dir):
    return R.scatter_sample(featured(spark, sf_dir), n=5000)


# --- prediction (ML1-ML9, TK6) -----------------------------------------------

_RUNS: dict = {}


@dataclass
class ClassifierRun:
    models: dict
    scored: DataFrame
    slots: DataFrame


def _inputs(sf_dir) -> list[str]:
    return [f"{sf_dir}/{t}.parquet" for t in STAR_TABLES]


def _classifier_run(spark, sf_dir) -> ClassifierRun:
    """Both classifiers fitted once per application and folder; the scored test rows are written."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        prepared = P.prepare(P.model_rows(featured(spark, sf_dir)))
        try:
            models = P.fit_all(prepared, P.classifiers())
            scored = stored(spark, "classifier-scores", _inputs(sf_dir), lambda: P.scored(prepared, models))
        finally:
            prepared.close()
        _RUNS[key] = ClassifierRun(models, scored, P.slot_dictionary(prepared.train_rows))
    return _RUNS[key]


@query("classifier_metrics")
def q_classifier_metrics(spark, sf_dir):
    return E.classifier_quality(_classifier_run(spark, sf_dir).scored, ["model"])


@query("classifier_confusion")
def q_classifier_confusion(spark, sf_dir):
    scored = _classifier_run(spark, sf_dir).scored.filter("model = 'RandomForest'").drop("model")
    return E.confusion(scored)


@query("classifier_importance")
def q_classifier_importance(spark, sf_dir):
    run = _classifier_run(spark, sf_dir)
    return P.feature_importance(run.models["RandomForest"], run.slots, top=15)


@query("regressor_metrics")
def q_regressor_metrics(spark, sf_dir):
    prepared = P.prepare(P.model_rows(featured(spark, sf_dir)))
    try:
        scored = P.scored(prepared, P.fit_all(prepared, P.regressor()), P.REG_LABEL)
        return spark.createDataFrame(E.regression_quality(scored).collect(), "metric string, value double")
    finally:
        prepared.close()


@query("model_split", O.with_model_rows("SELECT CASE WHEN draw < 0.8 THEN 'train' ELSE 'test' END AS side, "
                                        "is_delayed, count(*) AS flights FROM model_rows GROUP BY 1, 2"))
def q_model_split(spark, sf_dir):
    sides = zip(("train", "test"), E.keyed_split(P.model_rows(featured(spark, sf_dir))))
    train, test = (rows.select(F.lit(side).alias("side"), P.CLASS_LABEL) for side, rows in sides)
    return train.unionByName(test).groupBy("side", P.CLASS_LABEL).agg(F.count(F.lit(1)).alias("flights"))


@query("model_sample", O.with_model_rows(
    "SELECT is_delayed, count(*) AS flights FROM (SELECT *, count(*) OVER () AS n FROM model_rows) "
    "WHERE sample < 5000.0 / n OR n <= 5000 GROUP BY is_delayed"))
def q_model_sample(spark, sf_dir):
    rows = P.model_rows(featured(spark, sf_dir), max_rows=5000)
    return rows.groupBy(P.CLASS_LABEL).agg(F.count(F.lit(1)).alias("flights"))


@query("feature_slots", O.feature_slots())
def q_feature_slots(spark, sf_dir):
    train, _ = E.keyed_split(P.model_rows(featured(spark, sf_dir)))
    return P.slot_dictionary(train)


RATE_KEYS = ["op_unique_carrier", "dep_hour"]


def _rate_scores(spark, sf_dir) -> DataFrame:
    """The test rows scored by the training delay rate of their airline and hour."""
    train, test = E.keyed_split(P.model_rows(featured(spark, sf_dir)).withColumn("label", F.col(P.CLASS_LABEL).cast("double")))
    return E.rate_scores(train, test, RATE_KEYS)


@query("rate_classifier_metrics", O.rate_metrics())
def q_rate_classifier_metrics(spark, sf_dir):
    return E.classifier_quality(_rate_scores(spark, sf_dir))


@query("mean_regressor_metrics", O.mean_metrics())
def q_mean_regressor_metrics(spark, sf_dir):
    """The test rows' delay predicted by the training mean of their airline and hour."""
    train, test = E.keyed_split(P.model_rows(featured(spark, sf_dir)).withColumn("label", F.col(P.REG_LABEL)))
    scored = E.rate_scores(train, test, RATE_KEYS).withColumn("prediction", F.col("score"))
    return E.regression_quality(scored)


@query("rate_classifier_confusion", O.rate_confusion())
def q_rate_classifier_confusion(spark, sf_dir):
    return E.confusion(_rate_scores(spark, sf_dir))


# --- file round trip (IO1, IO3) ------------------------------------------------


def flights_csv(spark, sf_dir) -> str:
    """The raw flight table as a folder of gzipped header CSV, written once: a user's own files."""
    def write(path: str) -> None:
        with wide_job(spark, _inputs(sf_dir)):
            save_table(flight_tables(spark, sf_dir).raw_once, path, fmt="csv", compression="gzip")
    return stored_path(spark, "flights-csv", _inputs(sf_dir), write)


def csv_tables(spark, sf_dir) -> FlightTables:
    return flight_files(spark, flights_csv(spark, sf_dir))


@query("flights_from_csv", O.with_raw("SELECT * FROM flights_raw"))
def q_flights_from_csv(spark, sf_dir):
    """The raw flight table read back from CSV with the fixed schema."""
    return load_flights(spark, flights_csv(spark, sf_dir), fmt="csv")


@query("csv_flights_clean", ORACLE["flights_clean"])
def q_csv_flights_clean(spark, sf_dir):
    return csv_tables(spark, sf_dir).clean


@query("csv_duplicate_stats", ORACLE["duplicate_stats"])
def q_csv_duplicate_stats(spark, sf_dir):
    t = csv_tables(spark, sf_dir)
    return Q.duplicate_stats(t.raw_once, distinct=t.distinct)


@query("csv_delay_by_airline", ORACLE["delay_by_airline"])
def q_csv_delay_by_airline(spark, sf_dir):
    return S.breakdown(csv_tables(spark, sf_dir).featured, "airline")


# Planted bad cells of the CSV below: column, which flights (by number modulo 97), text.
BAD_CELLS = [("day_of_month", 3, "x"), ("crs_dep_time", 3, "12.7"), ("dep_delay", 5, "n/a"), ("cancelled", 7, "99999999999"),
             ("distance", 11, "far away")]


def _spoilt_csv(spark, sf_dir) -> str:
    """The raw flights as CSV with some cells that their columns cannot hold, written once."""
    def write(path: str) -> None:
        number = F.col("op_carrier_fl_num").cast("long") % 97
        spoilt = {c: F.when(number == at, F.lit(text)).otherwise(F.col(c).cast("string")) for c, at, text in BAD_CELLS}
        save_table(raw(spark, sf_dir).withColumns(spoilt), path)
    return stored_path(spark, "flights-spoilt-csv", _inputs(sf_dir), write)


@query("csv_rejected_cells", O.with_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{text}' AS text, count(*) AS cells FROM flights_raw "
    f"WHERE CAST(op_carrier_fl_num AS BIGINT) % 97 = {at}" for c, at, text in BAD_CELLS)))
def q_csv_rejected_cells(spark, sf_dir):
    rejected = load_rejects(spark, _spoilt_csv(spark, sf_dir))
    return rejected.groupBy(F.col("column").alias("column_name"), "text").agg(F.count(F.lit(1)).alias("cells"))


@query("airport_bubbles_csv", ORACLE["airport_bubbles"])
def q_airport_bubbles_csv(spark, sf_dir):
    """Coordinates from a file in which every code is repeated with other values; the least row stays."""
    coords = coords_for(spark, sf_dir)
    twice = coords.unionByName(coords.withColumns({"name": F.concat("name", F.lit(" (old)")), "lat": F.col("lat") + 1}))
    path = stored_path(spark, "coords-csv", [f"{sf_dir}/nation.parquet"], lambda p: save_table(twice, p))
    return N.airport_bubbles(featured(spark, sf_dir), read_dimension(spark, path), min_flights=200, on_repeat="least")


# --- further inventory forms (JN1, AD5 square, AN15/AN16/AN18/CL7 wide, TK3, TK5) ---

@query("airport_traffic_outer_join", ORACLE["airport_traffic"])
def q_airport_traffic_outer_join(spark, sf_dir):
    return N.traffic_by_join(featured(spark, sf_dir), top=20)


_CORR_WIDE = ", ".join(
    f"max(corr) FILTER (WHERE col_b = '{b}') AS {b}" for b in O.CORRELATED)


@query("correlation_matrix", O.with_featured(
    f"SELECT col_a AS column_name, {_CORR_WIDE} FROM ({_CORR}) GROUP BY col_a",
    ctes=f"cd AS (SELECT {_CD} FROM flights_featured WHERE {_CD_WHERE})"))
def q_correlation_matrix(spark, sf_dir):
    return R.correlation_matrix(featured(spark, sf_dir))


_LISTED = ["dep_delay", "arr_delay", "distance"]


@query("correlations_listed", O.with_featured(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {O.r_stable(f'corr({a}, {b})', 6)} AS corr FROM flights_featured "
    f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _LISTED)}" for a in _LISTED for b in _LISTED)))
def q_correlations_listed(spark, sf_dir):
    """CL12: a wanted column that the table does not have is left out."""
    return R.correlation_long(featured(spark, sf_dir), ["dep_delay", "arr_delay", "gate_delay", "distance"])


@query("cause_totals_wide", O.with_featured(
    "SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in CAUSES)
    + " FROM flights_featured"))
def q_cause_totals_wide(spark, sf_dir):
    return S.per_cause(featured(spark, sf_dir), S.minutes)


@query("cause_frequency_wide", O.with_featured(
    "SELECT " + ", ".join(f"{O.r(f'100 * avg(has_{c})', 2)} AS {c}" for c in CAUSES)
    + " FROM flights_featured"))
def q_cause_frequency_wide(spark, sf_dir):
    return S.per_cause(featured(spark, sf_dir), S.share_of_recorded)


@query("cause_by_month_wide", O.with_featured(
    "SELECT month, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in CAUSES)
    + " FROM flights_featured GROUP BY month"))
def q_cause_by_month_wide(spark, sf_dir):
    return S.per_cause(featured(spark, sf_dir), S.minutes, ["month"])


@query("null_counts_wide", O.with_raw(f"SELECT {_NULLS} FROM flights_raw"))
def q_null_counts_wide(spark, sf_dir):
    return Q.missing_value_report(raw(spark, sf_dir))


@query("busiest_origins", O.with_featured(
    f"SELECT origin, {O.SUMMARY} FROM flights_featured GROUP BY origin HAVING count(*) >= 200 "
    "ORDER BY flights DESC, origin LIMIT 20"))
def q_busiest_origins(spark, sf_dir):
    by_origin = S.breakdown(featured(spark, sf_dir), "origin", 200)
    return SC.top_rows(by_origin, 20, F.desc("flights"), "origin")


@query("delay_scatter_bernoulli", O.with_featured(
    f"SELECT dep_delay, arr_delay FROM (SELECT dep_delay, arr_delay, count(*) OVER () AS n, {O.draw('bernoulli-42')} AS draw FROM flights_featured) "
    "WHERE draw < least(1.0, 5000.0 / n) ORDER BY draw, dep_delay, arr_delay LIMIT 5000"))
def q_delay_scatter_bernoulli(spark, sf_dir):
    return R.scatter_sample(featured(spark, sf_dir), n=5000, method="bernoulli")


# --- approximate percentiles, the reference's own mode (AD2, AD4, AD12) ----------
# One KLL sketch per airline and day is stored; the queries merge them. A sketch draws
# random numbers, so its answers are held against their exact ranks: the SQL states
# what is promised, every answer within the bound.

def _sketches(spark, sf_dir) -> DataFrame:
    return stored(spark, "airline-day-sketches", _inputs(sf_dir),
                  lambda: D.sketch_values(featured(spark, sf_dir), "arr_delay", ["op_unique_carrier", "fl_date"]))


_POINTS = dict(zip(D.PERCENTILE_LABELS, D.PERCENTILES))


@query("arr_delay_percentiles_approx", O.with_featured(" UNION ALL ".join(
    f"SELECT '{lab}' AS percentile, count(arr_delay) AS flights, TRUE AS within_bound FROM flights_featured" for lab in O.PERCENTILES)))
def q_arr_delay_percentiles_approx(spark, sf_dir):
    answers = D.percentiles_of(D.merged_sketches(_sketches(spark, sf_dir)), _POINTS)
    return D.with_rank_error(answers, featured(spark, sf_dir), "arr_delay").select("percentile", "flights", "within_bound")


@query("airline_percentiles_approx", O.with_featured(" UNION ALL ".join(
    f"SELECT op_unique_carrier, '{lab}' AS percentile, count(*) AS flights, TRUE AS within_bound FROM flights_featured "
    "GROUP BY op_unique_carrier HAVING count(*) >= 1000" for lab in ("P50", "P90"))))
def q_airline_percentiles_approx(spark, sf_dir):
    by = ["op_unique_carrier"]
    answers = D.percentiles_of(D.merged_sketches(_sketches(spark, sf_dir), by), {"P50": 0.5, "P90": 0.9}, by)
    checked = D.with_rank_error(answers, featured(spark, sf_dir), "arr_delay", by)
    return checked.filter("flights >= 1000").select(*by, "percentile", "flights", "within_bound")


@query("airline_score_approx", O.with_featured(
    f"SELECT op_unique_carrier, flights, on_time_pct, avg_arr_delay, big_delay_pct, TRUE AS p90_within_bound FROM ({_SCORE})"))
def q_airline_score_approx(spark, sf_dir):
    by = ["op_unique_carrier"]
    answers = D.percentiles_of(D.merged_sketches(_sketches(spark, sf_dir), by), SC.SCORE_PERCENTILES, by)
    checked = D.with_rank_error(answers, featured(spark, sf_dir), "arr_delay", by)
    plain = SC.scorecard(featured(spark, sf_dir), points={}, min_flights=1000)
    return plain.join(checked.select(*by, F.col("within_bound").alias("p90_within_bound")), by)


# --- AG1 with the notebook's per-dimension HAVING thresholds -----------------------

@query("delay_all_dimensions_having", O.all_breakdowns(O.LEAST_FLIGHTS))
def q_delay_all_dimensions_having(spark, sf_dir):
    return S.all_breakdowns(featured(spark, sf_dir), min_flights={"origin": 200, "dest": 200, "route": 100})
