"""Session helpers of the training-data operators: the shared folder, lineage cuts, file shipping."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Separators of a word, as a regex class body: U+0020 and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
#: The same, as characters.
SEPARATORS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset
    (tests, one machine) a temporary folder of this machine, then set for the session."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    made = "file://" + tempfile.mkdtemp(prefix="strandmill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one file through Hadoop's file system, so path may be in any store that Spark writes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def ship_bytes(spark: SparkSession, name: str, data: bytes) -> str:
    """Put data into the shared folder and let Spark copy it to each executor once.
    Returns the name that pyspark.SparkFiles.get() resolves there, after a loss of executors too."""
    path = fresh_path(spark, name)
    write_bytes(spark, path, data)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


#: Bytes of a batch of rows that goes to a worker, where the session leaves Spark's default: batches stand twice in an
#: executor's memory outside its heap, for each of its tasks.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches() -> None:
    """Lowers the session's bytes of a batch to BATCH_BYTES, unless the session has a value of its own."""
    session = SparkSession.getActiveSession()
    if session is not None and BATCH_KEY not in session.conf.getAll:
        session.conf.set(BATCH_KEY, f"{BATCH_BYTES}b")


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after which the worker gives the memory it no longer uses back to the system: Spark keeps workers for later
    tasks, and what an idle one holds counts against its executor."""
    small_batches()

    def tidied(parts: Iterator) -> Iterator:
        try:
            yield from run(parts)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


def in_worker(run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], result: DataType) -> Callable[..., Column]:
    """A column function from a function of Arrow arrays: only its arguments go to Python and only its result comes back;
    the rows wait in the JVM, and no other column can clash. It is evaluated once wherever it is used."""
    tidied = tidy(run)
    tidied.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(tidied, result).asNondeterministic()


def free_name(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
