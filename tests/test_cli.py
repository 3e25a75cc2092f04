"""The job entry points, chained over file-backed topics like the original scripts."""

import os

from gearwatch.cli import main
from gearwatch.functions.codec import decode
from gearwatch.schemas import ALERT_EVENT
from gearwatch.sources.topics import ALERT_TOPIC, ENRICHED_TOPIC, RAW_TOPIC, read_topic


def test_jobs_end_to_end(spark, scratch):
    dims, topics = os.path.join(scratch, "dims"), os.path.join(scratch, "topics")
    assert main(["dims", "--out", dims, "--cars", "20"], spark) == 0
    assert main(["generate", "--dims", dims, "--events", "300", "--topics", topics], spark) == 0
    assert main(["enrich", "--dims", dims, "--topics", topics, "--available-now"], spark) == 0
    assert main(["detect", "--topics", topics, "--available-now", "--max-files-per-trigger", "2"],
                spark) == 0
    assert main(["inject", "--topics", topics], spark) == 0
    assert main(["count", "--topics", topics, "--available-now"], spark) == 0
    assert main(["fused", "--dims", dims, "--topics", topics, "--available-now"], spark) == 0
    counts = {t: read_topic(spark, t, root=topics, streaming=False).count()
              for t in (RAW_TOPIC, ENRICHED_TOPIC, ALERT_TOPIC)}
    assert counts[RAW_TOPIC] == counts[ENRICHED_TOPIC] == 300  # every generated car is known
    alerts = decode(read_topic(spark, ALERT_TOPIC, root=topics, streaming=False), ALERT_EVENT)
    assert alerts.where("driver_id IS NULL").count() == 0 and 1 < counts[ALERT_TOPIC] <= 301
    assert main(["smoke", "--out", os.path.join(scratch, "smoke"), "--topics", topics], spark) == 0
