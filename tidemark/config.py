"""Pipeline parameters, their bounds and the checks around user-supplied names and sizes."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass

from tidemark.contract import TABLES, TableSpec
from tidemark.session import STATE_CONF

LOGGER = logging.getLogger(__name__)

# Accepted spellings of booleans and of sizes, and the shortest salt.
TRUE_WORDS = {"1", "true", "t", "yes", "y", "on"}
FALSE_WORDS = {"0", "false", "f", "no", "n", "off"}
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3, "TB": 1024**4}
SALT_DIGITS = 32
DEFAULT_TOPIC = "financial.transactions"


def check_salt(salt: str | None) -> str:
    if not salt:
        raise ValueError("PII_HASH_SALT is required")
    if not re.fullmatch(r"[0-9a-fA-F]{%d,}" % SALT_DIGITS, salt):
        raise ValueError(f"PII_HASH_SALT needs {SALT_DIGITS} or more hex digits")
    return salt


def check_table_name(name: str) -> str:
    """A fully qualified ``catalog.schema.table`` name of plain identifiers."""
    parts = name.split(".")
    if len(parts) != 3 or not all(re.fullmatch(r"[^\W\d]\w*", part) for part in parts):
        raise ValueError(f"not a catalog.schema.table name: {name!r}")
    return name


def table_for(name: str) -> TableSpec:
    """The table behind a qualified name; the catalog part is free."""
    _, schema, table = check_table_name(name).split(".")
    return TABLES[f"{schema}.{table}"]


def parse_tables(text: str) -> list[str]:
    names = [check_table_name(part.strip()) for part in text.split(",") if part.strip()]
    if not names:
        raise ValueError("at least one table is required")
    return names


def parse_size(text: str) -> int:
    """Bytes of a size such as ``64MB``; zero, blanks inside and unknown units are refused."""
    match = re.fullmatch(r"([1-9][0-9]*)(B|KB|MB|GB|TB)", text.strip(), re.IGNORECASE)
    if match is None:
        raise ValueError(f"not a file size: {text!r}")
    return int(match[1]) * SIZE_UNITS[match[2].upper()]


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of a pipeline run; out-of-range numbers are moved to the nearest allowed one."""

    warehouse: str
    pii_hash_salt: str
    checkpoint_dir: str
    kafka_bootstrap_servers: str = "localhost:9092"
    source_topic: str = DEFAULT_TOPIC
    dedup_window_minutes: int = 1
    watermark_lateness_seconds: int = 5
    trigger_interval_ms: int = 300_000
    parallelism: int | None = None
    wait_for_job: bool = False

    def __post_init__(self) -> None:
        check_salt(self.pii_hash_salt)
        least = {
            "dedup_window_minutes": 1,
            "watermark_lateness_seconds": 0,
            "trigger_interval_ms": 1_000,
            "parallelism": 1,
        }
        for name, bound in least.items():
            if getattr(self, name) is not None:
                object.__setattr__(self, name, max(bound, getattr(self, name)))

    @property
    def stream_conf(self) -> dict[str, str]:
        """Session settings a stream takes over when it starts; its first start fixes the state partitions.

        Without a parallelism of its own it has the session's shuffle partitions.
        """
        own = {} if self.parallelism is None else {"spark.sql.shuffle.partitions": str(self.parallelism)}
        return {**own, **STATE_CONF}

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> PipelineConfig:
        env = os.environ if env is None else env
        warehouse = env.get("WAREHOUSE_DIR", "warehouse")
        return cls(
            warehouse=warehouse,
            pii_hash_salt=check_salt(env.get("PII_HASH_SALT")),
            checkpoint_dir=env.get("CHECKPOINT_DIR", f"{warehouse.rstrip('/')}/_checkpoints"),
            kafka_bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.kafka_bootstrap_servers),
            source_topic=env.get("KAFKA_TOPIC", cls.source_topic),
            dedup_window_minutes=_number(env, "DEDUP_WINDOW_MINUTES", cls.dedup_window_minutes),
            watermark_lateness_seconds=_number(
                env, "WATERMARK_LATENESS_SECONDS", cls.watermark_lateness_seconds
            ),
            trigger_interval_ms=_number(env, "TRIGGER_INTERVAL_MS", cls.trigger_interval_ms),
            parallelism=_number(env, "PARALLELISM", cls.parallelism),
            wait_for_job=_flag(env, "WAIT_FOR_JOB", cls.wait_for_job),
        )


def _number(env: Mapping[str, str], name: str, default: int | None) -> int | None:
    try:
        return int(env[name]) if name in env else default
    except ValueError:
        LOGGER.warning("%s=%r is not a whole number; using %s", name, env[name], default)
        return default


def _flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    word = env.get(name, str(default)).strip().lower()
    if word in TRUE_WORDS:
        return True
    if word not in FALSE_WORDS:
        LOGGER.warning("%s=%r is not a yes/no word; using %s", name, word, default)
        return default
    return False
