"""Image features by an Arrow UDF where an image library is installed; the rules on them are columns."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from fairground.functions import filters

FEATURES = StructType().add("width", IntegerType()).add("height", IntegerType()).add("phash", StringType()).add("edges", DoubleType())


def perceptual_hash(grey: np.ndarray) -> str:
    """64 bits of a 32 x 32 grey image: which of its 8 x 8 lowest cosine terms exceed their median."""
    n = np.arange(32)
    basis = np.cos(np.pi * np.outer(n[:8], n + 0.5) / 32)
    low = basis @ grey @ basis.T
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def edge_share(grey: np.ndarray, strong: float = 150.0) -> float:
    """Share of inner pixels whose Sobel gradient is strong."""
    g = grey.astype(float)
    x = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    y = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    return float((np.hypot(x, y) > strong).mean())


@F.pandas_udf(FEATURES)
def image_features(content: pd.Series) -> pd.DataFrame:
    """Size, perceptual hash and edge share of encoded images; all null for what cannot be read."""
    try:
        from PIL import Image
    except ImportError:
        Image = None

    def one(raw):
        if raw is None or Image is None:
            return (None, None, None, None)
        try:
            image = Image.open(io.BytesIO(raw))
            grey = image.convert("L")
            return (*image.size, perceptual_hash(np.asarray(grey.resize((32, 32)), float)), edge_share(np.asarray(grey.resize((200, 200)))))
        except OSError:
            return (None, None, None, None)

    return pd.DataFrame([one(x) for x in content], columns=["width", "height", "phash", "edges"])


def prefilter(images: DataFrame, cache: DataFrame) -> DataFrame:
    """``image, phash, motivo_scarto`` of ``images(image, content)``: why an image is dropped before extraction, or null.

    Hashes near to one of ``cache(phash, first_seen)`` are known images. What cannot be read is kept, with no hash.
    """
    from fairground.operators.dedup import similar_images

    seen = images.select("image", image_features("content").alias("f")).select("image", "f.*")
    return reasons(seen, similar_images(cache, seen.select("image", "phash")))


def reasons(features: DataFrame, near: DataFrame) -> DataFrame:
    """The rules on ``features(image, width, height, phash, edges)`` and the images ``near(image)`` that are known."""
    known = near.select("image", F.lit(True).alias("_known")).distinct()
    rows = features.join(known, "image", "left")
    why = filters.image_reason(F.col("width"), F.col("height"), F.coalesce("_known", F.lit(False)), F.col("edges"))
    return rows.select("image", "phash", why.alias("motivo_scarto"))
