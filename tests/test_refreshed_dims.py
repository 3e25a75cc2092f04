"""Dimensions replaced under a running enrichment."""

import os

import pytest

from gearwatch.functions.codec import decode
from gearwatch.schemas import ENRICHED_EVENT
from gearwatch.session import path_exists
from gearwatch.sources.dims import car_colors, car_models, current_version, publish_dimension
from gearwatch.sources.topics import ENRICHED_TOPIC, RAW_TOPIC, read_topic, write_topic
from gearwatch.streaming import jobs
from gearwatch.streaming.runner import await_or_stop


def fleet(spark, driver):
    return spark.createDataFrame([(1, driver, 1, 1)], "car_id long, driver_id long, model_id long, color_id long")


def send(spark, name, topics):
    text = f'{{"event_id":"{name}","car_id":1,"speed":10.0,"rpm":1,"gear":1}}'
    write_topic(spark.createDataFrame([(text,)], "value string"), RAW_TOPIC, root=topics)


def test_each_batch_takes_the_current_version_and_keeps_it(spark, scratch, monkeypatch):
    topics, dims, ck = (os.path.join(scratch, x) for x in ("topics", "dims", "ck"))
    with pytest.raises(ValueError):
        current_version(spark, f"{dims}/cars")
    for name, df in (("cars", fleet(spark, 100)), ("car_models", car_models(spark)), ("car_colors", car_colors(spark))):
        publish_dimension(df, f"{dims}/{name}", 1)

    def run():
        await_or_stop(jobs.start_refreshed_enrichment(spark, dims, checkpoint=ck, topics_root=topics, trigger="available-now"), 120)

    def drivers():
        records = read_topic(spark, ENRICHED_TOPIC, root=topics, streaming=False)
        return {r.event_id: r.driver_id for r in decode(records, ENRICHED_EVENT).collect()}

    send(spark, "a", topics)
    run()
    publish_dimension(fleet(spark, 200), f"{dims}/cars", 2)
    fleet(spark, 999).write.parquet(f"{dims}/cars/v=3")  # written, not published
    assert current_version(spark, f"{dims}/cars") == 2
    send(spark, "b", topics)
    real, died = jobs.enrichment_stage, []

    def dying(*args, **options):
        if not died and died.append(1) is None:
            raise RuntimeError("the driver dies")
        return real(*args, **options)

    monkeypatch.setattr(jobs, "enrichment_stage", dying)
    with pytest.raises(Exception, match="driver dies"):
        run()
    assert path_exists(spark, f"{ck}.dims/{1:012d}")
    publish_dimension(fleet(spark, 400), f"{dims}/cars", 4)
    run()  # the batch that failed takes the version that it had begun with
    send(spark, "c", topics)
    run()
    assert drivers() == {"a": 100, "b": 200, "c": 400}
