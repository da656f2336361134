"""Kafka source options and reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Default topics and the rate limit of one micro-batch.
TOPICS = ("cdc.public.users", "cdc.public.products", "cdc.public.orders")
MAX_OFFSETS_PER_TRIGGER = 50_000

_SCRAM = "org.apache.kafka.common.security.scram.ScramLoginModule"


def kafka_options(
    brokers: str,
    topics: Sequence[str] = TOPICS,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    security_protocol: str = "PLAINTEXT",
    username: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Source options; SASL settings only when both user and password are given."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        "kafka.security.protocol": security_protocol,
    }
    if username and password:
        options["kafka.sasl.mechanism"] = "SCRAM-SHA-256"
        options["kafka.sasl.jaas.config"] = f'{_SCRAM} required username="{username}" password="{password}";'
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of ``key, value, topic, partition, offset, timestamp``; needs the Kafka connector jar."""
    return spark.readStream.format("kafka").options(**options).load()
