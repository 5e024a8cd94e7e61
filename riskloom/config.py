"""Job settings: one importable dataclass, overridable from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class StreamConfig:
    servers: str = "localhost:9092"
    topic: str = "transactions"
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    trigger: str = "5 seconds"
    watermark: str = "1 minute"
    state_timeout: str = "10 minutes"
    output_mode: str = "append"
    security_protocol: str = ""
    sasl_mechanism: str = "PLAIN"
    sasl_user: str = field(default="", repr=False)
    sasl_password: str = field(default="", repr=False)

    @classmethod
    def from_env(cls, prefix: str = "RISKLOOM_") -> "StreamConfig":
        """Read ``<prefix><FIELD>`` variables; credentials never live in code."""
        values = {}
        for f in fields(cls):
            raw = os.environ.get(prefix + f.name.upper())
            if raw is not None:
                values[f.name] = int(raw) if f.name == "max_offsets_per_trigger" else raw
        return cls(**values)
