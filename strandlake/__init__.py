"""strandlake: amplicon-read and tandem-repeat analytics as Spark DataFrame plans."""

from __future__ import annotations

import os
import tempfile
import zipfile


def ship(spark) -> None:
    """Sends this package's source to the session's Python workers, once for each context.

    Workers then need no copy of their own; where they have one, it is the same code.
    """
    context = spark.sparkContext
    if getattr(context, "_strandlake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), "strandlake_source.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("strandlake", os.path.relpath(path, here)))
    context.addPyFile(archive)
    context._strandlake_shipped = True
