"""Spark settings: table catalog, object store and scale defaults.

These functions only return settings, so a job may equally pass them to ``spark-submit``.
Credentials are arguments; nothing is read from files, and nothing is logged.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Class names and property values a REST table catalog expects.
ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
ICEBERG_CATALOG = "org.apache.iceberg.spark.SparkCatalog"
ICEBERG_REST_CLIENT = "org.apache.iceberg.rest.RESTCatalog"
ALL_ROLES_SCOPE = "PRINCIPAL_ROLE:ALL"
ACCESS_DELEGATION = "vended-credentials"


def rest_catalog_conf(
    catalog: str,
    uri: str,
    *,
    warehouse: str | None = None,
    credential: str | None = None,
    scope: str = ALL_ROLES_SCOPE,
    s3_endpoint: str | None = None,
    s3_region: str | None = None,
    s3_access_key: str | None = None,
    s3_secret_key: str | None = None,
    default: bool = True,
) -> dict[str, str]:
    """Settings for an Iceberg REST catalog named ``catalog`` (its jars must be present)."""
    prefix = f"spark.sql.catalog.{catalog}"
    optional = {
        "credential": credential,
        "s3.endpoint": s3_endpoint,
        "s3.region": s3_region,
        "s3.access-key-id": s3_access_key,
        "s3.secret-access-key": s3_secret_key,
    }
    conf = {
        "spark.sql.extensions": ICEBERG_EXTENSIONS,
        prefix: ICEBERG_CATALOG,
        f"{prefix}.catalog-impl": ICEBERG_REST_CLIENT,
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse or catalog,
        f"{prefix}.scope": scope,
        f"{prefix}.header.X-Iceberg-Access-Delegation": ACCESS_DELEGATION,
        f"{prefix}.token-refresh-enabled": "true",
    }
    conf |= {f"{prefix}.{key}": value for key, value in optional.items() if value is not None}
    if s3_endpoint is not None:
        conf[f"{prefix}.s3.path-style-access"] = "true"
    if default:
        conf["spark.sql.defaultCatalog"] = catalog
    return conf


def object_store_conf(
    endpoint: str,
    *,
    access_key: str | None = None,
    secret_key: str | None = None,
    region: str | None = None,
    ssl: bool = False,
) -> dict[str, str]:
    """Settings for ``s3a://`` paths on an S3-compatible store."""
    prefix = "spark.hadoop.fs.s3a"
    conf = {
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.path.style.access": "true",
        f"{prefix}.connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key is not None:
        conf[f"{prefix}.access.key"] = access_key
    if secret_key is not None:
        conf[f"{prefix}.secret.key"] = secret_key
    if region is not None:
        conf |= {
            "spark.executorEnv.AWS_REGION": region,
            "spark.driver.extraJavaOptions": f"-Daws.region={region}",
            "spark.executor.extraJavaOptions": f"-Daws.region={region}",
        }
    return conf


def scale_conf(
    input_bytes: int, partition_bytes: int = 256 * 1024**2, max_partitions: int = 50_000
) -> dict[str, str]:
    """Settings for a job that reads and shuffles about ``input_bytes``.

    Adaptive execution merges small shuffle partitions but splits only skewed ones, so the
    initial number must already fit the data: the default of 200 would make 500 GB
    partitions out of 100 TB. Both sides of a shuffle are bounded, since the driver keeps a
    status entry per map task that grows with the number of partitions: beyond
    ``max_partitions`` of ``partition_bytes`` the partitions grow instead (and spill), and
    scan tasks read more than Spark's 128 MB each. Written files still aim at
    ``partition_bytes``.
    """
    partitions = min(max(200, math.ceil(input_bytes / partition_bytes)), max_partitions)
    scan_bytes = max(128 * 1024**2, math.ceil(input_bytes / (2 * max_partitions)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
    }


def build_session(app_name: str, *conf: Mapping[str, str], master: str | None = None) -> SparkSession:
    """Session with the given settings; later mappings win."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for settings in conf:
        for key, value in settings.items():
            builder = builder.config(key, value)
    return builder.getOrCreate()
