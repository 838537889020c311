"""Settings shared by the batch operators and the streaming jobs."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Defaults and environment names of the deployed jobs.
DEFAULT_WINDOW = "10 seconds"
DEFAULT_WATERMARK = "2 minutes"
ACCESS_TOPIC = "web-logs"
ERROR_TOPIC = "web-errors"


@dataclass(frozen=True)
class Thresholds:
    ip_requests: int = 50
    scan_paths: int = 20
    error_rate: float = 0.1


@dataclass(frozen=True)
class Settings:
    env: str = "dev"
    window: str = DEFAULT_WINDOW
    watermark: str = DEFAULT_WATERMARK
    thresholds: Thresholds = field(default_factory=Thresholds)
    error_samples: int = 5
    #: Relative error of a client's path count in the jobs; None counts exactly.
    path_error: float | None = None
    #: How long parsed rows stay after all metrics have read them.
    staged_keep: str = "1 hour"
    #: Where the jobs write points: "store" (metric tables) or "remote" (line-protocol endpoint).
    sink: str = "store"
    #: Time of error points: "window_end" or "processing_time".
    error_time: str = "window_end"
    remote_url: str = "http://influxdb:8086"
    remote_org: str = "primary"
    remote_bucket: str = "logs"
    remote_token: str = field(default="", repr=False)
    #: Lines a request, and how often a request is tried.
    remote_block: int = 5_000
    remote_tries: int = 5
    kafka_bootstrap: str = "kafka:9092"
    access_topic: str = ACCESS_TOPIC
    error_topic: str = ERROR_TOPIC
    access_offsets: str = "latest"
    error_offsets: str = "earliest"
    checkpoint_root: str | None = None
    error_checkpoint_root: str | None = None

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None) -> Settings:
        """Settings from the environment variables the jobs are deployed with."""
        e = os.environ if environ is None else environ
        rate = e.get("ERROR_RATE_THRESHOLD", e.get("THRESHOLD_ERROR_RATE", "0.1"))
        offsets = e.get("KAFKA_STARTING_OFFSETS")
        return cls(
            env=e.get("ENV_TAG", "dev"),
            window=e.get("WINDOW_DURATION", DEFAULT_WINDOW),
            watermark=e.get("WATERMARK", DEFAULT_WATERMARK),
            thresholds=Thresholds(
                ip_requests=int(e.get("IP_SPIKE_THRESHOLD", "50")),
                scan_paths=int(e.get("SCAN_DISTINCT_PATHS_THRESHOLD", "20")),
                error_rate=float(rate),
            ),
            path_error=float(e["SCAN_PATH_ERROR"]) if e.get("SCAN_PATH_ERROR") else None,
            staged_keep=e.get("STAGED_ROWS_KEEP", "1 hour"),
            sink=e.get("METRIC_SINK", "store"),
            error_time=e.get("ERROR_TIME_SOURCE", "window_end"),
            remote_url=e.get("INFLUX_URL", "http://influxdb:8086"),
            remote_org=e.get("INFLUX_ORG", "primary"),
            remote_bucket=e.get("INFLUX_BUCKET", "logs"),
            remote_token=e.get("INFLUX_TOKEN", ""),
            remote_block=int(e.get("REMOTE_BLOCK_LINES", "5000")),
            remote_tries=int(e.get("REMOTE_TRIES", "5")),
            error_samples=int(e.get("ERROR_SAMPLE_LIMIT", "5")),
            kafka_bootstrap=e.get("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092"),
            access_topic=e.get("KAFKA_TOPIC_ACCESS", ACCESS_TOPIC),
            error_topic=e.get("KAFKA_TOPIC_ERROR", ERROR_TOPIC),
            access_offsets=offsets or "latest",
            error_offsets=offsets or "earliest",
            checkpoint_root=e.get("CHECKPOINT_DIR"),
            error_checkpoint_root=e.get("CHECKPOINT_DIR_ERROR"),
        )
