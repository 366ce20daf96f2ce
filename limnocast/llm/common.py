"""Settings shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from limnocast.session import prepare

#: Rows in an Arrow batch of texts; Spark also ends a batch at its own limit of bytes.
BATCH_ROWS = 2000

_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application, so that their workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def ready(spark: SparkSession) -> SparkSession:
    """The session as the operators want it: AQE, small Arrow batches (texts can be long), their code shipped."""
    prepare(spark, finer=False).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
