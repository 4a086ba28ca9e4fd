"""Engine options.

Every place where the four original jobs disagree is an explicit option here
instead of a silent choice.  ``JOBS`` holds the four job variants as
configurations of one pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Quality ranges (inclusive), window size, watermark delay,
# trigger interval and result-output format used by the original jobs.
TEMPERATURE_RANGE = (-50.0, 80.0)
HUMIDITY_RANGE = (0.0, 100.0)
WINDOW = "1 minute"
WATERMARK_DELAY = "10 seconds"
TRIGGER_INTERVAL = "10 seconds"
WINDOW_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


@dataclass(frozen=True)
class EngineConfig:
    """Options of the pipeline.

    decode          "lenient": malformed or missing fields become null and the
                    row is rejected by the quality filter; "strict": any bad
                    record fails the query.
    time_mode       "iso": ISO-8601 with offset honoured (naive = UTC);
                    "prefix23": first 23 characters, 'T' -> ' ', offset cut off.
    quality_filter  apply the null and range rules (the pure-stream job does not).
    watermark_at    "enriched": watermark after filter and join;
                    "source": watermark right after decoding, with a guarded
                    filter so Catalyst cannot sink it below the watermark.
    delay           watermark delay; ``None`` keeps every window open (update
                    output only, unbounded state).
    rounding        "half_up": exact-cents arithmetic, HALF_UP;
                    "binary_half_even": Python-style rounding of the double.
    median          "histogram": a group's different readings meet in one task;
                    "rank": distributed rank selection, for readings of any
                    precision without a range filter (batches, cell sinks).
    dimension       "snapshot": the dimension is read once and pinned;
                    "refresh": re-read every micro-batch.
    bytes_per_trigger  most input bytes (whole files) of a micro-batch of a
                    file stream.
    output          "append": one row per closed window;
                    "update": changelog with one version per changed key.
    """

    window: str = WINDOW
    delay: str | None = WATERMARK_DELAY
    temperature_range: tuple[float, float] = TEMPERATURE_RANGE
    humidity_range: tuple[float, float] = HUMIDITY_RANGE
    time_mode: str = "iso"
    decode: str = "lenient"
    quality_filter: bool = True
    watermark_at: str = "enriched"
    rounding: str = "half_up"
    median: str = "histogram"
    dimension: str = "snapshot"
    output: str = "append"
    emit: str = "row"  # "row" (typed columns) or "json" (one string per result)
    trigger_interval: str = TRIGGER_INTERVAL
    bytes_per_trigger: int = 64 << 30
    name: str = "custom"

    def __post_init__(self) -> None:
        checks = {
            "time_mode": ("iso", "prefix23"),
            "decode": ("lenient", "strict"),
            "watermark_at": ("enriched", "source"),
            "rounding": ("half_up", "binary_half_even"),
            "median": ("histogram", "rank"),
            "dimension": ("snapshot", "refresh", "versions"),
            "output": ("append", "update"),
            "emit": ("row", "json"),
        }
        for attr, allowed in checks.items():
            value = getattr(self, attr)
            if value not in allowed:
                raise ValueError(f"{attr}={value!r}; expected one of {allowed}")
        if self.delay is None and self.output == "append":
            raise ValueError("append output needs a watermark delay")
        if self.dimension == "versions" and self.output == "update":
            raise ValueError("dimension versions need append output: a group's key holds the version")

    def with_(self, **changes) -> "EngineConfig":
        return replace(self, **changes)


# Input topic and one output topic (or folder) per job.
EVENTS_TOPIC = "iot_events"
OUTPUTS = {
    "hybrid": "iot_window_results",
    "table_upsert": "iot_aggregates_upsert",
    "bridge": "iot_window_results_table_sink",
    "pure": "iot_window_results_datastream",
}

# The four job variants as configurations of the one pipeline.
JOBS: dict[str, EngineConfig] = {
    # SQL join -> keyed event-time window -> JSON string per closed window.
    "hybrid": EngineConfig(name="hybrid", emit="json"),
    # SQL TUMBLE + GROUP BY after a join -> upsert changelog.
    "table_upsert": EngineConfig(
        name="table_upsert",
        time_mode="prefix23",
        watermark_at="source",
        output="update",
    ),
    # SQL join -> keyed window -> typed rows through a table sink.
    "bridge": EngineConfig(name="bridge", emit="row"),
    # Raw strings, strict parse, broadcast lookup, no quality filter.
    "pure": EngineConfig(
        name="pure", decode="strict", quality_filter=False, emit="json"
    ),
}
