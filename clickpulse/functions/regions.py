"""Province name normalisation and ISO 3166-2 region codes.

The lookup is a 34-entry literal map, so it is a projection inside whole-stage
codegen: no join, no exchange, nothing that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference's lookup): province name -> region code,
# 34 entries. The column name keeps the reference's spelling "iso_3316".
REGION_CODES: list[tuple[str, str]] = [
    ("北京", "CN-11"),
    ("天津", "CN-12"),
    ("河北", "CN-13"),
    ("山西", "CN-14"),
    ("内蒙古", "CN-15"),
    ("辽宁", "CN-21"),
    ("吉林", "CN-22"),
    ("黑龙江", "CN-23"),
    ("上海", "CN-31"),
    ("江苏", "CN-32"),
    ("浙江", "CN-33"),
    ("安徽", "CN-34"),
    ("福建", "CN-35"),
    ("江西", "CN-36"),
    ("山东", "CN-37"),
    ("河南", "CN-41"),
    ("湖北", "CN-42"),
    ("湖南", "CN-43"),
    ("广东", "CN-44"),
    ("广西", "CN-45"),
    ("海南", "CN-46"),
    ("重庆", "CN-50"),
    ("四川", "CN-51"),
    ("贵州", "CN-52"),
    ("云南", "CN-53"),
    ("西藏", "CN-54"),
    ("陕西", "CN-61"),
    ("甘肃", "CN-62"),
    ("青海", "CN-63"),
    ("宁夏", "CN-64"),
    ("新疆", "CN-65"),
    ("台湾", "CN-71"),
    ("香港", "CN-91"),
    ("澳门", "CN-92"),
]
# Fixed value: the city suffix dropped from municipality names.
CITY_SUFFIX = "市"

CODE_COLUMN = "province_iso_3316_code"


def normalize_province(c: Column | str = "province") -> Column:
    """A name ending in the city suffix loses every occurrence of it; others stay."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.endswith(F.lit(CITY_SUFFIX)), F.replace(c, F.lit(CITY_SUFFIX), F.lit(""))).otherwise(c)


def _code_map() -> Column:
    return F.create_map(*[F.lit(x) for pair in REGION_CODES for x in pair])


def region_code(c: Column | str = "province") -> Column:
    """Region code of a (normalised) province name; ``""`` when unknown."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(_code_map(), c), F.lit(""))


def with_region(df: DataFrame, province: str = "province") -> DataFrame:
    """Normalise ``province`` in place and add ``province_iso_3316_code``."""
    return df.withColumn(province, normalize_province(province)).withColumn(CODE_COLUMN, region_code(province))


def region_codes(spark: SparkSession) -> DataFrame:
    """The lookup as a two-column table (``province``, ``province_iso_3316_code``)."""
    return spark.createDataFrame(REGION_CODES, f"province string, {CODE_COLUMN} string")
