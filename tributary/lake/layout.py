"""Lake path convention.

    <source>/anio=YYYY/mes=MM/dia=DD/<source>_<YYYYMMDD>[_lote-NN].<ext>
    manifest = object key + '.manifiesto.json'

Month and day are always two digits, so text order of keys equals time
order. Keys starting with '_' are lake metadata, never data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.contract import (LAKE_LOT_TOKEN, LAKE_MANIFEST_SUFFIX, LAKE_PROBE_PREFIX,
                                LAKE_README_KEY)

KEY_PATTERN = r"^([a-z0-9_]+)/anio=(\d{4})/mes=(\d{2})/dia=(\d{2})/([^/]+)$"
FILE_PATTERN = r"^([a-z0-9_]+)_(\d{8})(_lote-(\d{2}))?\.([a-z0-9.]+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def partition_values(day) -> list[Column]:
    d = _c(day)
    return [F.date_format(d, "yyyy").alias("anio"), F.date_format(d, "MM").alias("mes"),
            F.date_format(d, "dd").alias("dia")]


def file_name(source, day, extension: str, lot=1) -> Column:
    """<source>_<YYYYMMDD>[_lote-NN].<ext>; lot 1 carries no suffix."""
    lot = F.lit(lot) if isinstance(lot, int) else _c(lot)
    base = F.concat(_c(source), F.lit("_"), F.date_format(_c(day), "yyyyMMdd"))
    base = F.when(lot > 1, F.concat(base, F.lit(LAKE_LOT_TOKEN), F.lpad(lot.cast("string"), 2, "0"))
                  ).otherwise(base)
    return F.concat(base, F.lit("."), F.lit(extension))


def raw_key(source, day, extension: str, lot=1) -> Column:
    """Deterministic key of a raw object: same source and day -> same key."""
    d = _c(day)
    return F.concat_ws("/", _c(source), F.concat(F.lit("anio="), F.date_format(d, "yyyy")),
                       F.concat(F.lit("mes="), F.date_format(d, "MM")),
                       F.concat(F.lit("dia="), F.date_format(d, "dd")),
                       file_name(source, day, extension, lot))


def manifest_key(key) -> Column:
    return F.concat(_c(key), F.lit(LAKE_MANIFEST_SUFFIX))


def is_metadata(key) -> Column:
    return _c(key).startswith("_")


def is_data(key) -> Column:
    return ~is_metadata(key) & ~_c(key).endswith(LAKE_MANIFEST_SUFFIX)


def classify(key) -> Column:
    """Readme / probe / lake metadata / manifest / data."""
    k = _c(key)
    return (F.when(k == LAKE_README_KEY, F.lit("readme"))
            .when(k.startswith(LAKE_PROBE_PREFIX), F.lit("probe"))
            .when(k.startswith("_"), F.lit("lake_metadata"))
            .when(k.endswith(LAKE_MANIFEST_SUFFIX), F.lit("manifest"))
            .otherwise(F.lit("data")))


def path_check(objects: DataFrame, sources: list[str], key: str = "object_key") -> DataFrame:
    """P10: every data key follows the convention; the first failing rule is
    reported: pattern, configured source, real calendar date, file-name
    pattern, file-name date equal to the partition date."""
    k = F.col(key)
    data = objects.where(is_data(k))
    part = lambda i: F.regexp_extract(k, KEY_PATTERN, i)
    name = part(5)
    day = F.try_to_date(F.concat_ws("-", part(2), part(3), part(4)), "yyyy-MM-dd")
    reason = (F.when(~k.rlike(KEY_PATTERN), F.lit("pattern"))
              .when(~part(1).isin(*sources), F.lit("source"))
              .when(day.isNull(), F.lit("calendar"))
              .when(~name.rlike(FILE_PATTERN), F.lit("file_name"))
              .when(F.regexp_extract(name, FILE_PATTERN, 2) != F.concat(part(2), part(3), part(4)),
                    F.lit("date_mismatch")))
    return data.select(k.alias("object_key"),
                       F.when(reason.isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                       reason.alias("reason"))
