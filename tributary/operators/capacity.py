"""Capacity projection (C1-C15): table-shaped, one row per measured source.

Inputs (rows, bytes, k, growth) are measured by Spark from the fact tables
per group; scenario grids are literal arrays exploded per source row (no
join at all), so the cost is O(sources x scenarios) column arithmetic.

Units: sizes are GiB (2^30 bytes) unless a column says ``_gb`` (10^9 bytes,
as providers bill); memory scenarios are GiB of RAM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.contract import CapacityPrices, MemoryScenarios
from tributary.functions.numeric import round_half_up
from tributary.functions.timeutil import BYTES_PER_GIB, gib_to_gb

MONTHS = 12


def _grid(items: list[dict]) -> Column:
    """A literal array of structs to explode against every source row."""
    return F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in it.items()]) for it in items]))


def monthly_rate(g: Column) -> Column:
    """(1 + g_annual)^(1/12) - 1 (not g/12)."""
    return F.pow(1 + g, F.lit(1.0 / 12)) - 1


def horizon(usable_gib: Column, k: Column, s0_gib: Column, g: Column) -> Column:
    """t = ln(M / (k * S0)) / ln(1 + g); negative = already exceeded.
    NULL when S0 <= 0, k <= 0 or g <= 0 (growth must be positive)."""
    ok = (s0_gib > 0) & (k > 0) & (g > 0)
    return F.when(ok, F.log(usable_gib / (k * s0_gib)) / F.log(1 + g))


def horizon_status(s0_gib: Column, k: Column, g: Column) -> Column:
    return (F.when((s0_gib <= 0) | (k <= 0), F.lit("no size"))
            .when(g <= 0, F.lit("growth must be > 0")).otherwise(F.lit("ok")))


def usable_memory(ram: Column, reserved: Column) -> Column:
    """Total x (1 - reserved fraction)."""
    return ram * (1 - reserved)


# --- inputs -----------------------------------------------------------------------

def capacity_inputs(measures: DataFrame, growth: DataFrame) -> DataFrame:
    """(source, rows, s0_gib, k, g, g_upper, v12_gib) per source.
    ``measures``: source, rows, stored_bytes, k; ``growth``: source, g, g_upper."""
    j = measures.join(growth, "source")
    s0 = F.col("stored_bytes") / F.lit(float(BYTES_PER_GIB))
    gm = monthly_rate(F.col("g"))
    return j.select("source", "rows", s0.alias("s0_gib"), "k", "g", "g_upper",
                    (s0 * F.pow(1 + gm, F.lit(float(MONTHS)))).alias("v12_gib"))


def project_full(sample: DataFrame, full_rows: DataFrame) -> DataFrame:
    """factor = full rows / sample rows; S0 = sample bytes x factor;
    memory = S0 x k (k measured on the sample)."""
    j = sample.join(full_rows, "source")
    factor = F.col("full_rows") / F.col("rows")
    s0 = F.col("stored_bytes") * factor
    return j.select("source", F.col("rows").alias("sample_rows"), "full_rows",
                    round_half_up(factor, 4).alias("factor"),
                    round_half_up(s0, 2).alias("s0_bytes"),
                    round_half_up(F.col("k"), 4).alias("k"),
                    round_half_up(s0 * F.col("k"), 2).alias("memory_bytes"))


# --- C2-C5 ---------------------------------------------------------------------------

def saturation_horizon(inputs: DataFrame, scen: MemoryScenarios = MemoryScenarios()) -> DataFrame:
    """C2 + C3 over the RAM scenarios with the declared reserved fraction."""
    grid = _grid([{"ram_gib": r, "reserved": scen.reserved_fraction} for r in scen.ram_gb])
    x = inputs.select("*", grid.alias("s"))
    usable = usable_memory(F.col("s.ram_gib"), F.col("s.reserved"))
    t = horizon(usable, F.col("k"), F.col("s0_gib"), F.col("g"))
    return x.select("source", F.col("s.ram_gib").alias("ram_gib"), F.col("s.reserved").alias("reserved"),
                    round_half_up(usable, 4).alias("usable_gib"),
                    round_half_up(F.col("k") * F.col("s0_gib"), 9).alias("need_gib"),
                    round_half_up(F.col("g"), 6).alias("g"),
                    round_half_up(t, 2).alias("horizon_years"),
                    horizon_status(F.col("s0_gib"), F.col("k"), F.col("g")).alias("status"))


def sensitivity(inputs: DataFrame, scen: MemoryScenarios = MemoryScenarios()) -> DataFrame:
    """C4: growth sweep and k sweep per source at the reference RAM; the
    reserved-fraction x RAM sweep on the most demanding source (max k*S0)."""
    ref_usable = scen.reference_ram_gb * (1 - scen.reserved_fraction)
    g_grid = _grid([{"sweep": "growth", "setting": f"g={g}", "gv": g, "km": 1.0, "usable": ref_usable}
                    for g in scen.growth_sweep])
    gk = inputs.select("*", g_grid.alias("s"))
    gk = gk.select("source", "s.sweep", "s.setting",
                   horizon(F.col("s.usable"), F.col("k"), F.col("s0_gib"), F.col("s.gv")).alias("t"))
    k_grid = _grid([{"sweep": "k", "setting": f"k*{m}", "km": m, "usable": ref_usable}
                    for m in scen.k_multipliers])
    kk = inputs.select("*", k_grid.alias("s"))
    kk = kk.select("source", "s.sweep", "s.setting",
                   horizon(F.col("s.usable"), F.col("k") * F.col("s.km"), F.col("s0_gib"), F.col("g"))
                   .alias("t"))
    top = inputs.agg(F.max(F.struct((F.col("k") * F.col("s0_gib")).alias("need"), "source"))
                     .alias("m")).select(F.col("m.source").alias("source"))
    r_grid = _grid([{"sweep": "reserved", "setting": f"reserved={fr},ram={r}", "fr": fr, "ram": r}
                    for fr in scen.reserved_sweep for r in scen.ram_gb])
    rr = inputs.join(F.broadcast(top), "source").select("*", r_grid.alias("s"))
    rr = rr.select("source", "s.sweep", "s.setting",
                   horizon(usable_memory(F.col("s.ram"), F.col("s.fr")), F.col("k"), F.col("s0_gib"),
                           F.col("g")).alias("t"))
    out = gk.unionByName(kk).unionByName(rr)
    return out.select("source", "sweep", "setting", round_half_up(F.col("t"), 2).alias("horizon_years"))


def sign_stability(grid: DataFrame) -> DataFrame:
    """Does the conclusion flip inside the grid? Lists the negative cells."""
    t = F.col("horizon_years")
    return grid.where(t.isNotNull()).groupBy("source").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count(F.when(t < 0, 1)).alias("negative_cells"),
        (F.bool_and(t < 0) | F.bool_and(t > 0)).alias("stable"),
        F.array_join(F.array_sort(F.collect_list(F.when(t < 0, F.col("setting")))), ";")
        .alias("negative_settings"))


# --- C6-C13 -----------------------------------------------------------------------------

def volume_by_month(inputs: DataFrame, months: int = MONTHS) -> DataFrame:
    """V(m) = S0 (1 + g_m)^m and the increment of every month."""
    gm = monthly_rate(F.col("g"))
    x = inputs.select("source", "s0_gib", gm.alias("gm"),
                      F.explode(F.sequence(F.lit(1), F.lit(months))).alias("month"))
    v = F.col("s0_gib") * F.pow(1 + F.col("gm"), F.col("month").cast("double"))
    inc = F.col("s0_gib") * (F.pow(1 + F.col("gm"), F.col("month").cast("double"))
                             - F.pow(1 + F.col("gm"), (F.col("month") - 1).cast("double")))
    return x.select("source", "month", round_half_up(v * BYTES_PER_GIB, 2).alias("volume_bytes"),
                    round_half_up(inc * BYTES_PER_GIB, 4).alias("increment_bytes"))


def blocks(size_gib: Column, block_mib: int) -> Column:
    """ceil(size / block)."""
    return F.ceil(size_gib * BYTES_PER_GIB / F.lit(float(block_mib * 1024 * 1024))).cast("bigint")


def replication_table(inputs: DataFrame, prices: CapacityPrices = CapacityPrices()) -> DataFrame:
    """physical = logical x R, extra vs R=1, tolerated losses R-1, minimum
    nodes R, yearly cloud cost (USD, local currency), raw-disk and TCO cost."""
    x = inputs.select("source", "v12_gib", _grid([{"R": r} for r in prices.replication_factors]).alias("s"))
    r = F.col("s.R")
    phys = F.col("v12_gib") * r
    gb = gib_to_gb(phys)
    cloud = gb * prices.cloud_usd_per_gb_month * 12
    disk = gb / 1000 * prices.disk_usd_per_tb
    return x.select("source", r.alias("R"),
                    round_half_up(F.col("v12_gib"), 9).alias("logical_gib"),
                    round_half_up(phys, 9).alias("physical_gib"),
                    round_half_up(gb, 9).alias("physical_gb"),
                    round_half_up(phys - F.col("v12_gib"), 9).alias("extra_vs_r1_gib"),
                    (r - 1).alias("tolerated_losses"), r.alias("min_nodes"),
                    round_half_up(cloud, 9).alias("cloud_usd_year"),
                    round_half_up(cloud * prices.cop_per_usd, 6).alias("cloud_local_year"),
                    round_half_up(disk, 9).alias("disk_usd"),
                    round_half_up(disk * prices.tco_multiplier, 9).alias("disk_tco_usd"))


def block_count(inputs: DataFrame, prices: CapacityPrices = CapacityPrices()) -> DataFrame:
    """Blocks of the 12-month single file, x R, and fill of the last block."""
    x = inputs.select("source", "v12_gib", _grid([{"R": r} for r in prices.replication_factors]).alias("s"))
    b = blocks(F.col("v12_gib"), prices.block_mib)
    block_gib = prices.block_mib / 1024
    fill = (F.col("v12_gib") - (b - 1) * block_gib) / block_gib
    return x.select("source", F.col("s.R").alias("R"), b.alias("blocks_r1"),
                    (b * F.col("s.R")).alias("blocks"),
                    round_half_up(fill, 6).alias("last_block_fill"))


def partitioning_overhead(inputs: DataFrame, prices: CapacityPrices = CapacityPrices(),
                          months: int = MONTHS) -> DataFrame:
    """One file vs base file + one file per monthly increment."""
    monthly = volume_by_month(inputs, months).select(
        "source", F.greatest(F.ceil(F.col("increment_bytes") / (prices.block_mib * 1024 * 1024)),
                             F.lit(0)).cast("bigint").alias("b"))
    mb = monthly.groupBy("source").agg(F.sum("b").cast("bigint").alias("monthly_blocks"))
    x = inputs.join(mb, "source")
    single = blocks(F.col("v12_gib"), prices.block_mib)
    base = blocks(F.col("s0_gib"), prices.block_mib)
    part = base + F.col("monthly_blocks")
    return x.select("source", single.alias("single_file_blocks"), base.alias("base_blocks"),
                    "monthly_blocks", part.alias("partitioned_blocks"),
                    (part - single).alias("overhead_blocks"), (part * 3).alias("partitioned_blocks_r3"))


def compression_scenarios(inputs: DataFrame, prices: CapacityPrices = CapacityPrices()) -> DataFrame:
    """Columnar compression factors: size, R=3 size, blocks, cost."""
    x = inputs.select("source", "v12_gib",
                      _grid([{"factor": f} for f in prices.compression_factors]).alias("s"))
    comp = F.col("v12_gib") / F.col("s.factor")
    return x.select("source", F.col("s.factor").alias("factor"),
                    round_half_up(comp, 9).alias("logical_gib"),
                    round_half_up(comp * 3, 9).alias("physical_r3_gib"),
                    blocks(comp, prices.block_mib).alias("blocks_r1"),
                    round_half_up(gib_to_gb(comp * 3) * prices.cloud_usd_per_gb_month * 12, 9)
                    .alias("cloud_r3_usd_year"))


def growth_sensitivity(inputs: DataFrame) -> DataFrame:
    """C11: measured growth, upper bound and zero growth."""
    x = inputs.select("*", F.explode(F.array(
        F.struct(F.lit("measured").alias("scenario"), F.col("g").alias("ga")),
        F.struct(F.lit("upper_bound").alias("scenario"), F.col("g_upper").alias("ga")),
        F.struct(F.lit("zero").alias("scenario"), F.lit(0.0).alias("ga")))).alias("s"))
    gm = monthly_rate(F.col("s.ga"))
    v = F.col("s0_gib") * F.pow(1 + gm, F.lit(float(MONTHS)))
    return x.select("source", "s.scenario", round_half_up(F.col("s.ga"), 6).alias("g_annual"),
                    round_half_up(gm, 6).alias("g_monthly"), round_half_up(v, 9).alias("v12_gib"),
                    round_half_up(v * 3, 9).alias("physical_r3_gib"))


def replica_breakeven(inputs: DataFrame, prices: CapacityPrices = CapacityPrices()) -> DataFrame:
    """Logical volume at which one more copy costs a yearly threshold,
    as a multiple of the 12-month volume, and years to reach it."""
    x = inputs.select("*", _grid([{"threshold_usd": u} for u in prices.breakeven_thresholds_usd]).alias("s"))
    v_gb = F.col("s.threshold_usd") / F.lit(prices.cloud_usd_per_gb_month * 12)
    factor = v_gb / gib_to_gb(F.col("v12_gib"))

    def years(g: Column) -> Column:
        return F.when(g > 0, F.log(factor) / F.log(1 + g))

    return x.select("source", F.col("s.threshold_usd").alias("threshold_usd"),
                    round_half_up(v_gb, 1).alias("volume_gb"), round_half_up(v_gb / 1000, 3).alias("volume_tb"),
                    round_half_up(factor, 1).alias("times_12m_volume"),
                    round_half_up(years(F.col("g")), 1).alias("years_central"),
                    round_half_up(years(F.col("g_upper")), 1).alias("years_upper"))


# Fixed values that must equal the reference's: the saving options (compression factor, replicas).
LEVERS = [("csv_r3_base", 1.0, 3), ("csv_r2", 1.0, 2), ("csv_r1", 1.0, 1),
          ("columnar_5x_r3", 5.0, 3), ("columnar_10x_r3", 10.0, 3)]


def saving_levers(inputs: DataFrame, levers=LEVERS) -> DataFrame:
    """Every (format, R) option against plain text at R=3."""
    x = inputs.select("source", "v12_gib",
                      _grid([{"lever": n, "factor": f, "R": r} for n, f, r in levers]).alias("s"))
    gib = F.col("v12_gib") / F.col("s.factor") * F.col("s.R")
    base = F.col("v12_gib") * 3
    return x.select("source", "s.lever", round_half_up(gib, 9).alias("physical_gib"),
                    round_half_up((1 - gib / base) * 100, 1).alias("saving_pct"))


# --- C14, C15 -------------------------------------------------------------------------

def annualized_need(readings: DataFrame, scen: MemoryScenarios = MemoryScenarios(),
                    growth=(0.10, 0.20, 0.40)) -> DataFrame:
    """Bytes per row x annual rows -> S0 per year, memory per year and
    month (x k), horizons for each memory scenario and growth rate.
    ``readings``: source, rows, stored_bytes, k, entities, span_days."""
    bpr = F.col("stored_bytes") / F.col("rows")
    annual = F.col("rows") / F.col("span_days") * 365
    s0y = bpr * annual / BYTES_PER_GIB
    memy = s0y * F.col("k")
    cols = [round_half_up(horizon(F.lit(ram * (1 - scen.reserved_fraction)), F.col("k"), s0y, F.lit(g)), 2)
            .alias(f"t_r{int(ram)}_g{int(g * 100)}") for ram in scen.ram_gb for g in growth]
    return readings.select("source", "entities", round_half_up(bpr, 2).alias("bytes_per_row"),
                           round_half_up(annual, 2).alias("rows_per_year"),
                           round_half_up(s0y, 9).alias("s0_year_gib"),
                           round_half_up(memy, 9).alias("memory_year_gib"),
                           round_half_up(memy / 12, 9).alias("memory_month_gib"), *cols)


def capacity_choice(needs: DataFrame, ram_options=(16.0, 32.0, 64.0, 128.0, 256.0), reserved: float = 0.35,
                    headroom: float = 2.0, growth: float = 0.20) -> DataFrame:
    """C14: smallest RAM option whose usable part covers ``headroom`` x the
    need, else the largest; entity limit = entities x usable / need; years
    until the chosen option saturates at ``growth``.
    ``needs``: source, entities, need_gib."""
    usable = [(r, r * (1 - reserved)) for r in ram_options]
    ok = F.array(*[F.when(F.lit(u) >= headroom * F.col("need_gib"), F.lit(r)) for r, u in usable])
    chosen = F.coalesce(F.array_min(ok), F.lit(max(ram_options)))
    u = chosen * (1 - reserved)
    return needs.select(
        "source", round_half_up(F.col("need_gib"), 9).alias("need_gib"), chosen.alias("ram_gib"),
        round_half_up(u, 4).alias("usable_gib"), (u >= headroom * F.col("need_gib")).alias("headroom_ok"),
        F.floor(F.col("entities") * u / F.col("need_gib")).cast("bigint").alias("entity_limit"),
        round_half_up(F.when(F.col("need_gib") > 0, F.log(u / F.col("need_gib")) / F.log(F.lit(1 + growth))), 1)
        .alias("years_at_growth"))
