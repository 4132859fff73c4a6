"""The sample store: derived metric samples, materialised once per input snapshot.

Series queries evaluate stored samples the way the modelled system queries its
time-series database, instead of re-deriving them from the events each time.
The store lives under the shared checkpoint folder, keyed by a fingerprint of
the input files (path, length, modification time) and of the derivation code
version, partitioned by series family so a query reads only the families it
names (partition pruning). A writer fills a folder of its own and then marks it
as committed, so readers never see a partial store and a lost executor only
costs a rerun of the write.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from candlewick.session import checkpoint_root

STORE_VERSION = "samples-v11"
_MARK = "_COMMITTED."


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def fingerprint(spark: SparkSession, paths: list[str], extra: str = "") -> str:
    """Hash of the input files' listing (metadata only, no data read)."""
    parts = [STORE_VERSION, extra]
    for path in paths:
        fs, p, _ = _fs(spark, path)
        found, files = fs.listFiles(p, True), []
        while found.hasNext():
            st = found.next()
            files.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
        parts += sorted(files)
    return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:20]


def _committed(fs, p) -> str | None:
    """Name of a finished attempt below the folder, the same one for every reader."""
    if not fs.exists(p):
        return None
    names = sorted(st.getPath().getName() for st in fs.listStatus(p))
    done = [n.removeprefix(_MARK) for n in names if n.startswith(_MARK)]
    return done[0] if done else None


def materialised(spark: SparkSession, name: str, inputs: list[str], build, extra: str = "") -> dict[str, DataFrame]:
    """Return {part: DataFrame} of a stored derivation, building it if absent.

    ``build()`` returns {part: DataFrame}; each part is written partitioned by
    ``family``. ``extra`` names the settings that the derivation depends on. Two
    writers at once each finish an attempt of their own; either one is whole."""
    final = f"{checkpoint_root(spark)}/store/{name}-{fingerprint(spark, inputs, extra)}"
    fs, p, jvm = _fs(spark, final)
    attempt = _committed(fs, p)
    if attempt is None:
        attempt = uuid.uuid4().hex[:12]
        for part, df in build().items():
            df.write.mode("overwrite").partitionBy("family").parquet(f"{final}/{attempt}/{part}")
        fs.create(jvm.org.apache.hadoop.fs.Path(p, _MARK + attempt), True).close()
        attempt = _committed(fs, p)
    done = jvm.org.apache.hadoop.fs.Path(p, attempt)
    parts = [st.getPath().getName() for st in fs.listStatus(done) if st.isDirectory()]
    return {part: spark.read.parquet(f"{final}/{attempt}/{part}") for part in parts}
