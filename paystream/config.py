"""Constants and job settings."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# They decide results or name the data a user already has.
WINDOW_SECONDS = 60
LATENESS_SECONDS = 120
EVENTS_TOPIC = "payments.events.v1"
AGGREGATES_TOPIC = "payments.aggregates.v1"
DEAD_LETTER_TOPIC = "payments.events.dlq.v1"
BOOTSTRAP_SERVERS = "localhost:9092"
BOOTSTRAP_ENV = "KAFKA_BOOTSTRAP_SERVERS"
SCHEMA_VERSION = 1
CURRENCY = "PYG"
STATUSES = ("CONFIRMED", "DECLINED", "PENDING")
COUNTED_STATUS = "CONFIRMED"

# Consumer groups of the two streaming jobs.
EVENTS_GROUP = "paystream-events"
AGGREGATES_GROUP = "paystream-aggregates"


@dataclass(frozen=True)
class StreamConfig:
    """Durations (seconds), state, topics and address of one deployment."""

    window_seconds: int = WINDOW_SECONDS
    lateness_seconds: int = LATENESS_SECONDS
    # State keys over which the exact stream spreads the ids it remembers; fixed for the life of
    # a checkpoint.
    buckets: int = 1024
    events_topic: str = EVENTS_TOPIC
    aggregates_topic: str = AGGREGATES_TOPIC
    dead_letter_topic: str = DEAD_LETTER_TOPIC
    bootstrap_servers: str = BOOTSTRAP_SERVERS

    @property
    def horizon_seconds(self) -> int:
        """How long an event id is remembered: as long as its window can still change."""
        return self.window_seconds + self.lateness_seconds

    @property
    def window(self) -> str:
        return f"{self.window_seconds} seconds"

    @property
    def lateness(self) -> str:
        return f"{self.lateness_seconds} seconds"

    @property
    def horizon(self) -> str:
        return f"{self.horizon_seconds} seconds"


DEFAULT = StreamConfig()


def bootstrap_servers(flag: str | None, env: Mapping[str, str] | None = None) -> str:
    """Address of the broker: the flag, else the environment, else the default."""
    return flag or (os.environ if env is None else env).get(BOOTSTRAP_ENV) or BOOTSTRAP_SERVERS
