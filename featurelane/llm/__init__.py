"""Operations of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this package.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


#: Texts go to the Python workers in batches of bounded size, unless the session sets its own.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}

#: Shuffle files go when the job that wrote them ends: stages are tables, so no later job reads them.
SHUFFLE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def ship(spark: SparkSession) -> None:
    """Send this library's Python files to the executors (once per context) and bound the Arrow batches.

    Tasks import the modules by name; where the package is installed on every node, or given with
    ``--py-files``, this only repeats it.
    """
    sc = spark.sparkContext
    given = sc.getConf()
    for name, value in (ARROW | SHUFFLE).items():
        if not given.contains(name):
            spark.conf.set(name, value)
    if getattr(sc, "_featurelane_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="featurelane-"), "featurelane_src.zip")  # read by the driver alone
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join(os.path.basename(top), os.path.relpath(path, top)))
    sc.addPyFile(target)
    sc._featurelane_shipped = True
