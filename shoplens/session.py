"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import math
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

MIB = 1 << 20
SCAN_WAVES = 24
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SKEWED_BLOCKS = "spark.shuffle.accurateBlockSkewedFactor"
AVERAGED_ABOVE = 2000


def settings_for(input_bytes: int, cores: int, shuffled_share: float = 0.2) -> dict[str, str]:
    """Settings sized from the bytes a job reads and the cores it runs on.

    AQE merges shuffle partitions that turn out small but never adds any, so their first number
    must not be too low: one per 512 MiB of the share of the input that is left after pruning
    columns, and never fewer than the cores. It must not be too high either, as every scan task
    writes a block for each of them; scans of very large inputs therefore use larger splits.
    """
    split = min(512 * MIB, max(128 * MIB, input_bytes // (cores * SCAN_WAVES)))
    partitions = max(cores, math.ceil(input_bytes * shuffled_share / (512 * MIB)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        INITIAL_PARTITIONS: str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        # one customer, product or NULL key may hold a third of the orders: such a shuffle
        # partition is cut into pieces, also where that costs one more exchange afterwards
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # beyond 2000 partitions block sizes are averaged, which hides that key, unless they stick
        # out by this factor
        SKEWED_BLOCKS: "5.0",
    }


def skew_risks(spark: SparkSession) -> list[str]:
    """What keeps AQE from cutting up hot keys and large groups in this session."""

    def off(name: str) -> bool:
        return spark.conf.get(name, "true").lower() != "true"

    switches = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    risks = [f"{name} is off" for name in switches if off(name)]
    unset = spark.conf.get("spark.sql.shuffle.partitions", "200")
    partitions = spark.conf.get(INITIAL_PARTITIONS, unset)
    if partitions == "200":
        # AQE adds no partitions to an aggregate
        risks.append(f"{INITIAL_PARTITIONS} is not sized for the input")
    factor = spark.sparkContext.getConf().get(SKEWED_BLOCKS, "-1")
    if int(partitions) > AVERAGED_ABOVE and float(factor) <= 0:
        risks.append(f"{partitions} shuffle partitions without {SKEWED_BLOCKS}")
    return risks


def sized_session(builder: SparkSession.Builder, folders: Sequence[str]) -> SparkSession:
    """A session with the settings for all bytes below ``folders``.

    What the submitter has set stays as it is, but for the time zone: days must not depend on the
    machine.
    """
    spark = builder.getOrCreate()
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(hadoop)
        if files.exists(path):
            size += files.getContentSummary(path).getLength()
    given = spark.sparkContext.getConf()
    for name, value in settings_for(size, spark.sparkContext.defaultParallelism).items():
        if name.startswith("spark.sql.session.") or not given.contains(name):
            if spark.conf.isModifiable(name):
                spark.conf.set(name, value)
    return spark


def local_session(cores: int = 8, driver_memory: str = "8g", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("shoplens")
    conf = settings_for(0, cores) | {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # without the Python line of every column in error messages, plans are built faster
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": driver_memory,
    }
    for name, value in (conf | extra).items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shoplens-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder all executors share.

    What is still there when the driver ends is deleted then. Only a local session may go without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_folder()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_delete_scratch)
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def _delete_scratch() -> None:
    from shoplens.sources.storage import delete_folder

    for spark, path in _scratch:
        # a session that has been stopped cannot delete any more
        with contextlib.suppress(Exception):
            delete_folder(spark, path)
    _scratch.clear()
