"""Table functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from vantagrid.functions import raster


class RasterComponents:
    """Components of one raster: a row of bounds and area for each, the largest first."""

    def eval(self, pixels: list, width: int, threshold: int) -> Iterator[tuple]:
        if pixels is None or not len(pixels):
            return
        image = np.array(pixels, np.int32).reshape(-1, width)
        for box in raster.components(raster.binarise(image, threshold)):
            yield box.x, box.y, box.w, box.h, box.mask_area


def register(spark: SparkSession) -> None:
    """Make ``raster_components(pixels, width, threshold)`` known to SQL."""
    spark.udtf.register("raster_components", udtf(RasterComponents, returnType="x int, y int, w int, h int, mask_area int"))
