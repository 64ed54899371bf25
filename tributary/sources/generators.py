"""Deterministic synthetic sources (S12-S14), driven by the rows of a base
table so the output grows with it. Randomness is a pure function of
(seed, row id, stream): uniform = xxhash64 scaled to [0, 1), normals by
Box-Muller, so any task can regenerate any row (retries give identical data).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import render_local_number

# Fixed values that must equal the reference's generators.
# Keyed-aggregation sample: 20 department keys with relative weights.
DEPARTMENT_WEIGHTS = [
    ("BOGOTA D.C.", 34), ("ANTIOQUIA", 18), ("VALLE DEL CAUCA", 11), ("CUNDINAMARCA", 8),
    ("SANTANDER", 6), ("ATLANTICO", 5), ("BOLIVAR", 3), ("NARINO", 3), ("TOLIMA", 2), ("HUILA", 2),
    ("CALDAS", 2), ("META", 1), ("CESAR", 1), ("CAUCA", 1), ("BOYACA", 1), ("RISARALDA", 1),
    ("QUINDIO", 1), ("AMAZONAS", 0.3), ("VAUPES", 0.2), ("GUAINIA", 0.2),
]
MODALITIES = ["Contratacion directa", "Licitacion publica", "Minima cuantia", "Seleccion abreviada"]
LOGNORMAL_MU, LOGNORMAL_SIGMA = 17.2, 1.1
# Meter readings: quality flags with probabilities, municipalities.
QUALITY_FLAGS = [("OK", 0.94), ("ESTIMADO", 0.05), ("SIN_SENAL", 0.01)]
MUNICIPALITIES = ["Girardot", "Espinal", "Flandes", "Ricaurte"]
# Procurement-shaped rows: entities, modalities, description vocabulary, URL prefix.
ENTITIES = ["MUNICIPIO DE SOLEDAD", "ESE HOSPITAL DEPARTAMENTAL UNIVERSITARIO DEL QUINDIO",
            "DEPARTAMENTO ADMINISTRATIVO NACIONAL DE ESTADISTICA (DANE)"]
WIDE_MODALITIES = ["Contratacion directa", "Licitacion publica", "Minima cuantia"]
DESCRIPTION_WORDS = ("PRESTACION DE SERVICIOS PROFESIONALES ESPECIALIZADOS PARA APOYAR "
                     "JURIDICAMENTE LOS PROCESOS DE COBRO RECAUDO Y RECUPERACION DE CARTERA "
                     "DEL MUNICIPIO CONFORME AL PLAN DE ACCION EN SALUD VIGENCIA").split()
NOTICE_URL = "https://community.secop.gov.co/Public/Tendering/OpportunityDetail/Index?noticeUID=CO1.NTC."

_TWO53 = 2 ** 53


def uniform(seed: int, row_id: Column, stream: int) -> Column:
    """Deterministic U[0, 1) per (seed, row, stream): 53 hash bits, exact."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), row_id)
    return F.pmod(h, F.lit(_TWO53)).cast("double") / F.lit(float(_TWO53))


def with_row_hash(base: DataFrame, row_id: Column, seed: int) -> tuple[DataFrame, Column]:
    """Stage one 64-bit hash per row; every stream derives from it. The hash
    is not a cheap expression and is used by every column, so the optimizer
    keeps it in its own projection, which keeps the generated code of wide
    generators small enough to be compiled."""
    return base.withColumn("_h0", F.xxhash64(F.lit(seed), row_id)), F.col("_h0")


def normal(seed: int, row_id: Column, stream: int) -> Column:
    """Deterministic N(0, 1) by Box-Muller over two uniform streams."""
    u1 = F.greatest(uniform(seed, row_id, stream), F.lit(1e-300))
    u2 = uniform(seed, row_id, stream + 1)
    return F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2)


def weighted_choice(u: Column, choices: list[tuple[str, float]]) -> Column:
    """Inverse-CDF pick from a small literal table as a CASE chain over the
    cumulative bounds: no join and no per-row array."""
    total = sum(w for _, w in choices)
    acc = 0.0
    expr = None
    for name, w in choices[:-1]:
        acc += w / total
        v = F.lit(name).cast("string")
        expr = F.when(u < acc, v) if expr is None else expr.when(u < acc, v)
    last = F.lit(choices[-1][0]).cast("string")
    return last if expr is None else expr.otherwise(last)


def round_even(x: Column, decimals: int) -> Column:
    """Half-even rounding of a generated double in floating point (rint), as
    array libraries round; avoids a per-value decimal conversion."""
    scale = float(10 ** decimals)
    return F.rint(x * scale) / scale


def pick(u: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.floor(u * len(values)) + 1).cast("int"))


def skewed_records(base: DataFrame, row_id: Column, seed: int = 20260814) -> DataFrame:
    """One contract-like record per base row: weighted department key,
    lognormal value rendered in local format, entity, modality, 2025 date."""
    rid = row_id
    value = F.exp(LOGNORMAL_MU + LOGNORMAL_SIGMA * normal(seed, rid, 2))
    month = (F.floor(uniform(seed, rid, 5) * 12) + 1).cast("int")
    day = (F.floor(uniform(seed, rid, 6) * 28) + 1).cast("int")
    return base.select(
        F.format_string("C-%06d", rid).alias("id_contrato"),
        weighted_choice(uniform(seed, rid, 1), DEPARTMENT_WEIGHTS).alias("departamento"),
        F.format_string("Entidad %03d", (F.floor(uniform(seed, rid, 4) * 400) + 1).cast("int")).alias("entidad"),
        pick(uniform(seed, rid, 7), MODALITIES).alias("modalidad"),
        render_local_number(value, 2).alias("valor_contrato"),
        F.make_date(F.lit(2025), month, day).alias("fecha_firma"))


def meter_readings(meters: DataFrame, meter_id: Column, hours: int = 168, seed: int = 42) -> DataFrame:
    """Hourly readings of every meter: daily sine profile plus noise,
    quality flags 94/5/1 %, municipality. Each meter row explodes into its
    hours (a generator, not a join). The narrow meters are dealt to all tasks
    first, as the readings are ``hours`` times as many as the rows that a
    split of the source holds; a meter's name is made once."""
    tasks = int(meters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-03-01 00:00:00")) + F.col("_h") * 3600)
    hod = F.col("_h") % 24
    base = 0.12 + 0.08 * F.pow(F.sin((hod - 6) * math.pi / 12), 2)
    m = meters.select(meter_id.cast("bigint").alias("_m")).repartition(tasks)
    m = m.select("_m", F.concat(F.lit("MED-"), F.lpad(F.col("_m").cast("string"), 7, "0")).alias("meter_id"),
                 h.alias("_h"))
    rid = F.col("_m") * hours + F.col("_h")
    cons = round_even(F.abs(base + 0.03 * normal(seed, rid, 1)), 4)
    return m.select("meter_id", ts.cast("timestamp_ntz").alias("reading_ts"), cons.alias("consumption_m3"),
                    weighted_choice(uniform(seed, rid, 3), QUALITY_FLAGS).alias("quality_flag"),
                    pick(uniform(seed, rid, 4), MUNICIPALITIES).alias("municipality"))


def wide_text_rows(base: DataFrame, row_id: Column, seed: int = 42) -> DataFrame:
    """Procurement-shaped rows dominated by free text (12-44 words)."""
    rid = row_id
    n_words = (F.floor(uniform(seed, rid, 1) * 33) + 12).cast("int")
    words = F.array(*[F.lit(w) for w in DESCRIPTION_WORDS])
    text = F.array_join(F.transform(
        F.sequence(F.lit(1), n_words),
        lambda i: F.element_at(words, (F.pmod(F.xxhash64(F.lit(seed), rid, i), F.lit(len(DESCRIPTION_WORDS)))
                                       + 1).cast("int"))), " ")
    return base.select(
        F.concat(F.lit("CO1.PCCNTR."), F.lpad(rid.cast("string"), 7, "0")).alias("id_proceso"),
        pick(uniform(seed, rid, 2), ENTITIES).alias("entidad"),
        text.alias("descripcion_del_procedimiento"), text.alias("objeto_del_contrato"),
        pick(uniform(seed, rid, 3), WIDE_MODALITIES).alias("modalidad"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.floor(uniform(seed, rid, 4) * 900).cast("int"))
        .alias("fecha_de_publicacion"),
        (F.floor(uniform(seed, rid, 5) * (900_000_000 - 1_000_000)) + 1_000_000).cast("bigint").alias("precio_base"),
        F.concat(F.lit(NOTICE_URL), rid.cast("string")).alias("urlproceso"))


def survey_rows(base: DataFrame, row_id: Column, seed: int = 7, questions: int = 25) -> DataFrame:
    """Household-survey-shaped rows: 3 ids and ``questions`` columns in
    three families (coded text with 10 % NULL, money with 25 % NULL, ints).

    Every uniform stream is staged once as a column, and the question columns
    are derived from those columns, so no stream is recomputed inside CASE
    branches and the generated code stays compact."""
    base, h = with_row_hash(base, row_id, seed)
    streams = [1, 2, 3]
    for i in range(1, questions + 1):
        streams.append(100 + i)
        if i % 3 == 1:
            streams += [200 + 2 * i, 201 + 2 * i]
    u = base.select(*[uniform(seed, h, k).alias(f"_u{k}") for k in streams])

    def col(k):
        return F.col(f"_u{k}")

    def gauss(k):
        return F.sqrt(-2 * F.log(F.greatest(col(k), F.lit(1e-300)))) * F.cos(2 * math.pi * col(k + 1))

    cols = [(F.floor(col(1) * 59999) + 1).cast("bigint").alias("directorio"),
            (F.floor(col(2) * 8) + 1).cast("bigint").alias("secuencia_p"),
            (F.floor(col(3) * 11) + 1).cast("bigint").alias("orden")]
    for i in range(1, questions + 1):
        q = col(100 + i)
        name = f"p65{i:02d}"
        if i % 3 == 0:
            c = weighted_choice(q, [("1", 0.45), ("2", 0.35), ("9", 0.10), (None, 0.10)])
        elif i % 3 == 1:
            c = F.when(q >= 0.25, round_even(1_000_000 + 400_000 * gauss(200 + 2 * i), 1))
        else:
            c = F.floor(q * 99).cast("bigint")
        cols.append(c.alias(name))
    return u.select(*cols)
