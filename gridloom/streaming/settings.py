"""Settings of the consumers: defaults, reading, and checks that name what is wrong."""

from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Group:
    """How a consumer cuts its stream: a batch closes at so many rows or after so much time."""

    batch_rows: int
    batch_millis: int

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.batch_millis} milliseconds"}


@dataclass(frozen=True)
class Settings:
    """Where the consumers read and write, how long they remember, and how they cut their streams."""

    servers: str = "localhost:9092"
    raw_topic: str = "raw"
    clean_topic: str = "clean"
    dead_letter_topic: str = "dead-letter"
    folder: str = "telemetry"
    registry_url: str = ""
    registry_seconds: int = 300
    registry_wait_seconds: int = 90
    dedup_ttl_seconds: int = 120
    state_ttl_seconds: int = 300
    metrics_port: int = 0
    analytics: Group = field(default_factory=lambda: Group(5000, 1000))
    realtime: Group = field(default_factory=lambda: Group(750, 25))

    def check(self) -> "Settings":
        """Itself, or a ValueError with all that is wrong."""
        wrong = []
        for name in ("servers", "raw_topic", "clean_topic", "dead_letter_topic", "folder"):
            if not getattr(self, name).strip():
                wrong.append(f"{name} is empty")
        topics = (self.raw_topic, self.clean_topic, self.dead_letter_topic)
        if len(set(topics)) < len(topics):
            wrong.append("topics must differ")
        for name in ("registry_seconds", "registry_wait_seconds", "dedup_ttl_seconds", "state_ttl_seconds"):
            if getattr(self, name) <= 0:
                wrong.append(f"{name} must be above 0")
        if not 0 <= self.metrics_port < 65536:
            wrong.append("metrics_port must be between 0 and 65535")
        for name in ("analytics", "realtime"):
            for part in ("batch_rows", "batch_millis"):
                if getattr(getattr(self, name), part) <= 0:
                    wrong.append(f"{name}.{part} must be above 0")
        if wrong:
            raise ValueError("; ".join(wrong))
        return self


def read(values: dict[str, Any]) -> Settings:
    """Settings from a mapping (a parsed file): what it leaves out keeps its default, unknown names and
    values of another type are errors."""
    known = {f.name: f for f in fields(Settings)}
    default, made, wrong = Settings(), {}, []
    for name, value in values.items():
        if name not in known:
            wrong.append(f"unknown setting {name}")
            continue
        old = getattr(default, name)
        if isinstance(old, Group):
            parts = {"batch_rows": old.batch_rows, "batch_millis": old.batch_millis}
            if not isinstance(value, dict) or not set(value) <= set(parts) or not all(type(v) is int for v in value.values()):
                wrong.append(f"{name} must give batch_rows and batch_millis as whole numbers")
                continue
            made[name] = Group(**{**parts, **value})
        elif type(value) is not type(old):
            wrong.append(f"{name} must be {'text' if isinstance(old, str) else 'a whole number'}")
        else:
            made[name] = value
    if wrong:
        raise ValueError("; ".join(wrong))
    return Settings(**made).check()
