"""Session helpers shared by the text operators: bounded Arrow batches, cut lineage, components."""

from __future__ import annotations

import atexit
import ctypes
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one Arrow batch brings to a Python worker, a single longer text aside.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Used only in local mode where the session names no spark.checkpoint.dir, as in tests.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def bounded_batches(spark: SparkSession) -> None:
    """Make the session fit for Python workers.

    Arrow batches end at BATCH_BYTES, or at less where the session says so, so that a worker's memory follows bytes and
    not rows; the setting stays for the session. Workers look for this package where the driver found it; a cluster
    that lacks that path gets it by --py-files, as usual."""
    given = spark.conf.get(BATCH_SETTING, None) or ""
    if not given.isdigit() or not 0 < int(given) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    if home not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [home, workers.get("PYTHONPATH")]))


def tidy() -> None:
    """Give memory that a batch has freed back to the system: workers live on, and several share an executor."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


_own_dirs: dict[str, str] = {}
_open: list[Scope] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a session whose driver is its one executor, as in tests, may go without: it gets a folder of its own."""
    named_ = spark.conf.get("spark.checkpoint.dir", None)
    if named_:
        return named_
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _own_dirs.setdefault(spark.sparkContext.applicationId, f"{LOCAL_CHECKPOINTS}/{spark.sparkContext.applicationId}")


class Scope:
    """Tables written while it is open are deleted at its end, but for those kept: they pass to the scope around it."""

    def __init__(self):
        self.held: list[DataFrame] = []
        self.kept: list[DataFrame] = []

    def __enter__(self) -> Scope:
        _open.append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(df)
        return df

    def __exit__(self, *_) -> None:
        _open.pop()
        kept = {getattr(df, "_annoforge_path", None) for df in self.kept}
        for df in self.held:
            if df._annoforge_path not in kept:
                forget(df)
            elif _open:
                _open[-1].held.append(df)


def scope() -> Scope:
    return Scope()


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: later plans start from those files.

    The table goes with the scope it is made in, or with forget(); else with the driver, at its end."""
    path = f"{shared_dir(df.sparkSession)}/annoforge/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._annoforge_path = path
    if _open:
        _open[-1].held.append(out)
    _left[path] = df.sparkSession
    return out


_left: dict[str, SparkSession] = {}


def _delete(path: str) -> None:
    spark = _left.pop(path, None)
    if spark is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a cut() that no later plan reads."""
    _delete(getattr(df, "_annoforge_path", ""))


@atexit.register
def forget_all() -> None:
    """At the driver's end, delete what results still read from."""
    for path in list(_left):
        try:
            _delete(path)
        except Exception:  # the session's JVM may have gone first
            _left.clear()


#: Bytes up to which a table is broadcast.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """df, marked to be broadcast if its rows' bytes stay below BROADCAST_BYTES; else the join shuffles."""
    size = df.agg(F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: list[str], *names: str) -> list[str]:
    """These names, changed where a column has them already."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id"):
    """Column: crc32 of the id as text leaves remainder 2 by 4; a null id is never held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


#: Edges of a node beyond which they are not joined with its least neighbour by a shuffle on the node.
HUB = 1024


def with_least(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """rows (u, v) with m, the least node that u has: nodes has (u, m, n), n the rows that u counts.

    The rows of a hub stay where they are: hubs, of which there are as many as rows / HUB at most, are sent to them."""
    hubs = nodes.where(F.col("n") > HUB).select("u", "m")
    if hubs.isEmpty():
        return rows.join(nodes.drop("n"), "u")
    hubs = small(hubs, F.lit(16))
    calm = rows.join(hubs.select("u"), "u", "left_anti").join(nodes.where(F.col("n") <= HUB).drop("n"), "u")
    return rows.join(hubs, "u").unionByName(calm)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of long pairs: (node, component), component the smallest node reachable.

    Alternating large-star and small-star rounds: each keeps the components and flattens the trees, so
    rounds grow with the logarithm of the longest path. Every round is written and read again. A star's
    rows are sums over its own edges only; no list of neighbours is ever built. Nodes without an edge
    do not appear. Self pairs and nulls are ignored; repeated pairs count once.
    """
    now = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    size = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = with_least(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        stars = (
            with_least(large, low2)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        after = cut(stars, "edges")
        state = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        forget(now)
        now = after
        if state == size:
            break
        size = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
