from pyspark.sql import functions as F

from gearwatch.operators.enrich import PROFILE_COLUMNS, car_profiles, enrich, lookup
from gearwatch.operators.joins import broadcast_if_small, hot_keys, planned_bytes, salted_left_join
from gearwatch.sources.dims import car_colors, car_models, smoke_table, with_model_names
from gearwatch.schemas import RAW_EVENT


def bag(df, cols=None):
    """Order-insensitive row multiset (NULL-safe)."""
    d = df.select(*(cols or sorted(df.columns)))
    return sorted((tuple(r) for r in d.collect()), key=repr)


def _events(spark, car_ids):
    rows = [(f"e{i}", None, c, 100.0, 3000, 4) for i, c in enumerate(car_ids)]
    return spark.createDataFrame(rows, RAW_EVENT)


def _cars(spark, rows):
    return spark.createDataFrame(rows, "car_id bigint, driver_id bigint, model_id bigint, color_id bigint")


def test_literal_lookups(spark):
    assert car_models(spark).count() == 7 and car_colors(spark).count() == 7
    assert with_model_names(car_models(spark)).where("model_id = 6").first()[1:] == ("Kia", "Rio")
    assert [r.color_name for r in car_colors(spark).orderBy("color_id").collect()][:2] == ["Black", "Red"]
    assert smoke_table(spark).count() == 3
    plan = car_models(spark)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan


def test_join_fanout_miss_and_null(spark):
    cars = _cars(spark, [(1, 101, 1, 1), (1, 102, 2, 2), (2, 201, 9, 4)])
    out = enrich(_events(spark, [1, 2, 3, None]), cars, car_models(spark), car_colors(spark))
    rows = sorted(out.collect(), key=lambda r: (r.event_id, r.driver_id or 0))
    assert [(r.event_id, r.driver_id) for r in rows] == [
        ("e0", 101), ("e0", 102), ("e1", 201), ("e2", None), ("e3", None)]
    e1 = [r for r in rows if r.event_id == "e1"][0]
    assert (e1.brand_name, e1.model_name, e1.color_name) == (None, None, "White")  # model 9 unknown
    assert out.columns == [f.name for f in RAW_EVENT.fields] + list(PROFILE_COLUMNS) + ["expected_gear"]
    assert dict(out.dtypes)["car_id"] == "int"


def _written(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_broadcast_only_what_the_planner_sizes_small(spark, scratch):
    cars = _written(spark, _cars(spark, [(i, i, 1, 1) for i in range(10)]), f"{scratch}/cars")
    size = planned_bytes(cars)
    assert broadcast_if_small(cars, size)[1] and not broadcast_if_small(cars, size - 1)[1]
    wide = _written(spark, cars.withColumn("photo", F.repeat(F.sha2(F.col("car_id").cast("string"), 256), 20_000)),
                    f"{scratch}/wide")  # ten rows, many bytes
    assert not broadcast_if_small(wide, 100_000)[1]
    ev = _events(spark, [1, 2])
    plan_small = enrich(ev, cars, car_models(spark), car_colors(spark))
    plan_big = enrich(ev, cars, car_models(spark), car_colors(spark), broadcast_max_bytes=0)
    s = plan_small._jdf.queryExecution().executedPlan().toString()
    b = plan_big._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in s and "LeftOuter" in s
    assert "SortMergeJoin" in b
    assert bag(plan_big) == bag(plan_small)


def test_size_check_runs_no_job(spark, scratch):
    cars = _written(spark, _cars(spark, [(1, 1, 1, 1)]), f"{scratch}/cars")
    sc = spark.sparkContext
    sc.setJobGroup("size-check", "size check")
    try:
        broadcast_if_small(cars)
        car_profiles(cars, car_models(spark), car_colors(spark))
        assert not sc.statusTracker().getJobIdsForGroup("size-check")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_salted_join_equals_plain_join_under_skew(spark):
    # car 7 holds a third of all events; cars 7 and 8 are listed twice
    ids = [7] * 300 + list(range(600)) + [None] * 5
    ev = _events(spark, ids)
    cars = _cars(spark, [(i, 1000 + i, 1, 1) for i in range(500)] + [(7, 9999, 2, 2), (8, 8888, 3, 3)])
    plain = ev.join(cars, "car_id", "left")
    hot = hot_keys(ev, "car_id", share=1 / 9)
    assert hot == [7]
    salted = salted_left_join(ev, cars, "car_id", ["event_id"], 16, hot)
    cols = sorted(plain.columns)
    assert bag(salted, cols) == bag(plain, cols)
    assert hot_keys(ev.where("false"), "car_id") == [] and hot_keys(ev.where("car_id is null"), "car_id") == []


def test_many_hot_keys_are_all_salted(spark):
    """The threshold follows the total, so the list is short and nothing is switched off."""
    ev = _events(spark, [k for k in range(100) for _ in range(40)] + [7] * 2000)
    hot = hot_keys(ev, "car_id", share=1 / 200)
    assert hot[0] == 7 and len(hot) == 100
    assert hot_keys(ev, "car_id", share=1 / 10) == [7]


def test_enrich_auto_salts_when_dimension_is_large(spark):
    ids = [3] * 200 + list(range(100)) + [None] * 40
    ev = _events(spark, ids)
    cars = _cars(spark, [(i, 1000 + i, 1 + i % 7, 1 + i % 7) for i in range(50)])
    auto = enrich(ev, cars, car_models(spark), car_colors(spark), broadcast_max_bytes=0, salt_buckets=8)
    ref = enrich(ev, cars, car_models(spark), car_colors(spark), broadcast_max_bytes=0, skew="aqe")
    assert bag(auto) == bag(ref)
    assert "__salt" in auto._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_and_profiles(spark):
    cars = _cars(spark, [(1, 11, 3, 6)])
    prof = car_profiles(cars, car_models(spark), car_colors(spark)).first()
    assert (prof.brand_name, prof.model_name, prof.color_name) == ("Toyota", "Corolla", "Blue")
    out = lookup(_events(spark, [1, 5]), cars, "car_id").orderBy("event_id").collect()
    assert [r.driver_id for r in out] == [11, None]


def _off(spark, request, **conf):
    for name, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", **conf}.items():
        spark.conf.set(name, value)
        request.addfinalizer(lambda name=name: spark.conf.unset(name))


def test_bucketed_profiles_shuffle_only_the_events(spark, scratch, request):
    from gearwatch.operators.enrich import save_profiles
    cars = _cars(spark, [(i, 1000 + i, 1 + i % 7, 1 + i % 7) for i in range(300)])
    prof = save_profiles(cars, car_models(spark), car_colors(spark), table="gw_test_profiles",
                         path=f"{scratch}/profiles/v=1", buckets=4)
    ev = _events(spark, list(range(0, 400, 3)) + [None] * 9)
    out = enrich(ev, profiles=prof)
    _off(spark, request)  # the table is tiny here
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    ref = enrich(ev, cars, car_models(spark), car_colors(spark))
    assert bag(out) == bag(ref)
    from gearwatch.streaming.runner import await_or_stop, start_materialize
    ev.write.parquet(f"{scratch}/ev")
    source = spark.readStream.schema(ev.schema).parquet(f"{scratch}/ev")
    for name, options in (("bucketed", {"profiles": prof}),
                          ("shuffled", {"profiles": car_profiles(cars, car_models(spark), car_colors(spark)),
                                        "broadcast_max_bytes": 0})):
        q = start_materialize(enrich(source, **options), output_mode="append", out_dir=f"{scratch}/{name}",
                              checkpoint=f"{scratch}/{name}-ck")
        assert await_or_stop(q, 300)
        assert bag(spark.read.parquet(f"{scratch}/{name}"), sorted(ref.columns)) == bag(ref)


def test_hot_and_null_keys_spread_over_tasks(spark, scratch, request):
    """Shuffled, bucketed and streaming joins all put them into six of eight tasks at least."""
    from gearwatch.operators.enrich import save_profiles
    from gearwatch.streaming.runner import await_or_stop
    _off(spark, request, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = _events(spark, [7] * 3000 + list(range(3000)) + [None] * 3000)
    cars = _cars(spark, [(i, 1000 + i, 1, 1) for i in range(100)])
    dims = cars, car_models(spark), car_colors(spark)

    def spread(df):
        rows = df.select("car_id", F.spark_partition_id().alias("p")).distinct()
        return [rows.where(c).count() for c in ("car_id = 7", "car_id is null")]

    assert spread(ev.join(cars, "car_id", "left")) == [1, 1]
    assert min(spread(enrich(ev, *dims, broadcast_max_bytes=0))) >= 6
    prof = save_profiles(*dims, table="gw_spread_profiles", path=f"{scratch}/profiles/v=1", buckets=8, salts=32)
    assert min(spread(enrich(ev, profiles=prof))) >= 6
    ev.write.parquet(f"{scratch}/ev")
    found = []
    source = spark.readStream.schema(ev.schema).parquet(f"{scratch}/ev")
    q = enrich(source, *dims, broadcast_max_bytes=0).writeStream.foreachBatch(
        lambda batch, _: found.append(spread(batch))).option("checkpointLocation", f"{scratch}/ck").trigger(
        availableNow=True).start()
    assert await_or_stop(q, 300)
    assert min(found[0]) >= 6
