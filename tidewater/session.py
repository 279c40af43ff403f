"""Session settings and job parameters."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """Arbitrary-state operators need the RocksDB provider."""
    for key in (
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    ):
        spark.conf.set(key, SETTINGS[key])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    fallback = tempfile.mkdtemp(prefix="tidewater-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def read_properties(text: str) -> dict[str, str]:
    """``key=value`` lines; ``#`` and ``!`` start a comment line."""
    pairs = (line.strip() for line in text.splitlines())
    split = (p.partition("=") for p in pairs if p and p[0] not in "#!" and "=" in p)
    return {key.strip(): value.strip() for key, _, value in split}


def read_arguments(args: Iterable[str]) -> dict[str, str]:
    """``--key value`` pairs; a key without a value counts as ``true``."""
    found: dict[str, str] = {}
    key = None
    for arg in args:
        if arg.startswith("-") and not arg[1:2].isdigit():
            key = arg.lstrip("-").strip()
            found[key] = "true"
        elif key is None:
            raise ValueError(f"value without a key: {arg!r}")
        else:
            found[key], key = arg, None
    return found
