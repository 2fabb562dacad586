"""Plan-shape and hot-key checks: partial aggregation, pushdown, pruning, bounded broadcast."""

from conftest import SF01, flight_rows

from tarmac.functions.derive import add_features
from tarmac.operators import distribution as D
from tarmac.operators import quality as Q
from tarmac.operators import summarize as S
from tarmac.sources.store import flight_tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_rows(spark, n=300):
    """A third of the rows on one airline, and a third identical copies of one row."""
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(dict(op_unique_carrier="HOT", origin="A", dest="B", month=1,
                             cancelled=0, diverted=0, dep_delay=5.0, arr_delay=7.0))
        else:
            rows.append(dict(op_unique_carrier=f"C{i % 7}", origin="A", dest="C", month=1 + i % 12,
                             cancelled=0, diverted=0, dep_delay=float(i % 50),
                             arr_delay=float(i % 61 - 10), crs_dep_time=i % 2400))
    return flight_rows(spark, rows)


def test_hot_key_and_hot_copies(spark):
    df = _hot_rows(spark)
    by = {r.op_unique_carrier: r.flights for r in S.breakdown(add_features(df), "airline").collect()}
    assert by["HOT"] == 100 and sum(by.values()) == 300
    d = Q.duplicate_stats(df).first()
    assert d.total_rows == 300 and d.duplicate_rows == 99 + (200 - df.filter("op_unique_carrier != 'HOT'").distinct().count())
    assert Q.clean_flights(df).filter("op_unique_carrier = 'HOT'").count() == 1


def test_breakdowns_aggregate_map_side(spark):
    f = flight_tables(spark, SF01).featured
    for df in (S.breakdown(f, "airline"), Q.drop_duplicates(f), S.all_breakdowns(f),
               D.group_percentiles(f)):
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        # a partial aggregate below the exchange and a final one above it
        assert final.count("Aggregate(") >= 2, final[:500]


def _formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filters_and_columns_reach_the_scan(spark):
    t = flight_tables(spark, SF01)
    plan = _formatted(S.counts_where(t.raw, "cancelled", "cancellation_code", "cancellations"))
    assert "PushedFilters: [IsNotNull(cancelled), EqualTo(cancelled,1)]" in plan
    plan = _formatted(S.breakdown(t.featured, "airline"))
    assert "EqualTo(diverted,0)" in plan
    assert "ReadSchema: struct<op_unique_carrier:string,dep_delay:double,arr_delay:double," in plan


def test_traffic_is_one_shuffle_no_join(spark):
    from tarmac.operators.network import airport_traffic
    df = airport_traffic(flight_tables(spark, SF01).featured, top=None)
    df.collect()
    plan = _plan(df)
    assert "Join" not in plan and "Generate" in plan


def test_shuffle_partitions_for_raises_and_restores(spark):
    from tarmac.session import shuffle_partitions_for
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffle_partitions_for(spark, 10 * 2**30) as n:       # 10 GiB -> 120 partitions
        assert n == 120 and spark.conf.get(key) == "120"
    assert spark.conf.get(key) == before
    with shuffle_partitions_for(spark, 1) as n:                 # tiny input keeps the session value
        assert n == int(before) and spark.conf.get(key) == before
    with shuffle_partitions_for(spark, 10**14) as n:            # 100 TB, no cap
        assert n == -(-10**14 * 3 // (256 * 2**20))
    assert spark.conf.get(key) == before


def test_path_bytes_counts_written_files(spark):
    from tarmac.session import path_bytes
    raw = flight_tables(spark, SF01).raw
    assert path_bytes(spark, raw.inputFiles()[0].rsplit("/", 1)[0]) > 100_000


def test_distinct_rows_collapse_before_they_move(spark):
    # raw copies collapse map-side; the second exchange moves rows that are distinct already
    plan = _formatted(Q.distinct_counts(flight_tables(spark, SF01).raw)).split("\n\n")[0]
    assert plan.count("Exchange (") == 2 and plan.rindex("HashAggregate") > plan.rindex("Exchange")


def test_rows_moved_once_give_the_same_counts(spark):
    days = ["2024-01-05", "+02024-01-05", "junk", "junk", "trash", None, None]
    rows = [dict(fl_date=d, origin=o, dep_delay=x) for d in days for o in ("A", None) for x in (0.0, -0.0, float("nan"), None)]
    df = flight_rows(spark, rows * 3)
    found = [sorted(map(str, Q.distinct_counts(df, move_once=once).collect())) for once in (False, True)]
    assert found[0] == found[1] and len(found[0]) == 2 * 3 * 2
    plan = _formatted(Q.distinct_counts(flight_tables(spark, SF01).raw, move_once=True)).split("\n\n")[0]
    assert plan.count("Exchange (") == 1


def test_small_tasks_lowers_and_restores(spark):
    from tarmac.session import TASK_SIZE_KEYS, small_tasks
    before = [spark.conf.get(k) for k in TASK_SIZE_KEYS]
    with small_tasks(spark, 1 << 20):
        assert [spark.conf.get(k) for k in TASK_SIZE_KEYS] == ["1048576b"] * 2
        with small_tasks(spark):
            assert [spark.conf.get(k) for k in TASK_SIZE_KEYS] == ["1048576b"] * 2
    assert [spark.conf.get(k) for k in TASK_SIZE_KEYS] == before
