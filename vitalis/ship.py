"""The package on the Python workers of a cluster."""

from __future__ import annotations

import io
import os
import sys
import zipfile

from pyspark.sql import SparkSession

from vitalis.session import checkpoint_dir

_shipped: set[str] = set()


def archive(root: str) -> bytes:
    """The package's modules as a zip."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(os.path.join(root, "vitalis"))):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    return out.getvalue()


def ensure_on_workers(spark: SparkSession) -> None:
    """Send the package to the workers, once for an application, unless they
    find it by ``PYTHONPATH``: as a zip in the shared checkpoint folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if app in _shipped or root in paths:
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/vitalis-code-{app}.zip")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(archive(root)))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(fs.makeQualified(target).toString())
    if root not in sys.path:
        sys.path.insert(0, root)
    _shipped.add(app)
