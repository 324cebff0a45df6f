"""Features stored as Parquet, laid out so that the common filters skip data.

* one directory per type: a type test reads only its own files;
* hot tag keys as flat columns: a tag test reaches the scan's statistics,
  which a test on map values cannot;
* flat integer bounds, rows in Z-order: a box test skips row groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.features import BOUNDS, features
from waymark.sources.tables import OsmTables

# Fixed value: the keys worth a column of their own.
HOT_KEYS = ("building", "highway", "amenity", "name", "leisure", "landuse")
STORED_COLUMNS = ("fid", "type", "tags", "is_area", *BOUNDS)


def write_features(tables: OsmTables, path: str, columns: Iterable[str] = STORED_COLUMNS,
                   hot_keys: Iterable[str] = HOT_KEYS, mode: str = "errorifexists") -> None:
    """Write the feature view. Add ``geom``, ``members`` or ``parents`` to store them too."""
    columns = list(dict.fromkeys([*STORED_COLUMNS, *columns]))
    rows = features(tables, columns).select(
        "*", *[F.col("tags")[k].alias(_flat(k)) for k in hot_keys],
        F.expr(z_order("xmin", "ymin")).alias("cell"))
    # The id breaks up cells that hold very many features.
    (rows.repartitionByRange("type", "cell", "fid").sortWithinPartitions("type", "cell", "fid")
     .drop("cell").write.mode(mode).partitionBy("type").parquet(path))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored_tag(df: DataFrame, key: str) -> Column:
    """The tag's flat column where it was stored as one, else the map entry."""
    return df[_flat(key)] if _flat(key) in df.columns else df["tags"][key]


def _flat(key: str) -> str:
    return f"tag_{key}"


def z_order(x: str, y: str) -> str:
    """Interleave the high 16 bits of both axes."""
    def spread(value):
        text = f"(shiftright({value}, 16) + 32768)"
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            text = f"(({text} | shiftleft({text}, {shift})) & {mask})"
        return text

    return f"({spread(f'CAST({x} AS BIGINT)')} | shiftleft({spread(f'CAST({y} AS BIGINT)')}, 1))"
