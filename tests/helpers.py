"""Small builders for staged streaming fixtures."""

from __future__ import annotations

import json
import os
import time

from skein.sources.dimensions import MANUFACTURER_ROWS
from skein.schemas import MANUFACTURERS

DAY = "2026-06-05"


def event(mid, hms, temp=20.0, hum=50.0, sensor="sensor-001"):
    return {
        "sensor_id": sensor,
        "manufacturer_id": mid,
        "event_time": f"{DAY}T{hms}{'' if '.' in hms else '.000000'}+00:00",
        "temperature": temp,
        "humidity": hum,
    }


def stage_files(folder: str, batches: list[list]) -> str:
    """One JSON-lines file per micro-batch, with strictly increasing mtimes."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"{i:03d}.json")
        with open(path, "w") as f:
            for r in rows:
                f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
        os.utime(path, (base + i, base + i))
    return folder


def dimension(spark, ids=(1, 2)):
    rows = [r for r in MANUFACTURER_ROWS if r[0] in ids]
    return spark.createDataFrame(rows, MANUFACTURERS)


def collect_batches(results_df, checkpoint, output_mode="append"):
    """Run available-now with a foreachBatch collector: {batch_id: rows}."""
    seen = {}

    def grab(df, batch_id):
        seen[batch_id] = sorted(
            (r.window_start[11:16], r.manufacturer_id, r.events_count, r.avg_temperature, r.median_humidity)
            for r in df.collect()
        )

    q = (
        results_df.writeStream.outputMode(output_mode)
        .foreachBatch(grab)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    assert q.awaitTermination(300)
    return q, seen
