"""Declared parameters (the "contracts") that drive the operators.

Each dataclass is a plain value object; no operator reads globals.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's for identical results.
# Parse contract of the keyed-aggregation source: symbols removed before
# parsing, thousands separator, decimal separator, placeholder for empty keys,
# intermediate field separator.
REFERENCE_STRIP_SYMBOLS = ("$", " ", "%")
REFERENCE_THOUSANDS = "."
REFERENCE_DECIMAL = ","
REFERENCE_EMPTY_KEY = "(SIN DATO)"
REFERENCE_FIELD_SEPARATOR = "\t"
# Lake path convention tokens: partition names, lot suffix, manifest suffix.
LAKE_PARTITION_TOKENS = ("anio", "mes", "dia")
LAKE_LOT_TOKEN = "_lote-"
LAKE_MANIFEST_SUFFIX = ".manifiesto.json"
LAKE_README_KEY = "_LEEME.txt"
LAKE_PROBE_PREFIX = "_evidencia/"
LAKE_MAX_LOTS = 99


@dataclass(frozen=True)
class KeyValueContract:
    """How to pull a (key, numeric value) pair out of a text record."""

    key_col: str
    value_col: str
    normalize_key: bool = True
    empty_key: str = REFERENCE_EMPTY_KEY
    strip_symbols: tuple[str, ...] = REFERENCE_STRIP_SYMBOLS
    thousands: str | None = REFERENCE_THOUSANDS
    decimal: str = REFERENCE_DECIMAL
    output_decimals: int = 2


@dataclass(frozen=True)
class LakeLayout:
    """Bucket-per-layer lake with a fixed key convention."""

    prefix: str = "lake"
    layers: tuple[str, ...] = ("raw", "refined", "curated")
    versioned: tuple[bool, ...] = (True, False, False)
    manifest_suffix: str = LAKE_MANIFEST_SUFFIX
    extension: str = "csv"

    def bucket(self, layer: str) -> str:
        if layer not in self.layers:
            raise ValueError(f"unknown layer {layer!r}; layers are {self.layers}")
        return f"{self.prefix}-{layer}"


@dataclass(frozen=True)
class CapacityPrices:
    """Price and platform constants of the storage projection."""

    cloud_usd_per_gb_month: float = 0.023
    disk_usd_per_tb: float = 12.0
    tco_multiplier: float = 3.0
    cop_per_usd: float = 3144.14
    block_mib: int = 128
    replication_factors: tuple[int, ...] = (1, 2, 3)
    compression_factors: tuple[float, ...] = (5.0, 10.0)
    breakeven_thresholds_usd: tuple[int, ...] = (100, 1_000, 10_000)


@dataclass(frozen=True)
class MemoryScenarios:
    """Memory scenarios of the saturation horizon (GB, reserved fraction)."""

    ram_gb: tuple[float, ...] = (8.0, 16.0, 32.0)
    reserved_fraction: float = 0.35
    growth_sweep: tuple[float, ...] = (0.01, 0.02, 0.04, 0.08, 0.16, 0.32)
    k_multipliers: tuple[float, ...] = (0.5, 1.0, 2.0, 4.0)
    reserved_sweep: tuple[float, ...] = (0.25, 0.35, 0.50)
    reference_ram_gb: float = 16.0
    extra: dict = field(default_factory=dict)
