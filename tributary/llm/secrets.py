"""Secret scan with multipart credential linking (operator 3).

DataFrame and SQL functions only. One scan of the texts cuts out all parts:

* base parts, reported as they are: ``assign`` (a named value of 12 or more
  characters), ``access`` (AKIA identifiers of 18 or more), ``hex`` (runs of 16
  or more);
* weak parts: other cloud access identifiers (``key``), long mixed runs
  (``secret``), addresses of services (``endpoint``).

A weak part alone means little. It is reported only when complementary parts
co-occur with it in one scope (a document, and at most ``SCOPE`` code points
between the starts): a ``secret`` with an access identifier, a ``key`` with a
secret, an ``endpoint`` with both. The co-occurrence is an interval join: parts
are joined by document and bin of SCOPE code points, one side repeated in the
two neighbouring bins. A bin holds at most SCOPE / 14 parts, so neither a very
long text nor a text full of parts makes a hot group. A weak part that
overlaps a base span is not reported.

Positions: the pieces between a pattern's matches and the matches themselves
alternate, so starts are running sums of their lengths, taken by a window over
(document, pattern). Only lengths are shuffled, never text.

No pattern repeats a group, so a text of any length and any repetition is
scanned in bounded stack.

Defined results: null and empty texts have no parts. Every input row gives one
row; rows with equal or null ids, repeated rows too, are kept apart. Other
columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import stage

SCOPE = 512
#: Kinds in listing order; the first three are the base.
KINDS = ("assign", "access", "hex", "key", "secret", "endpoint")

# The patterns of the parts, and the least length of what they match
# (for assign: of its second group).
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{16,}+", 0, 16),
    "key": (r"(?<![A-Z0-9])(?:ASIA|AIDA|AROA|LTAI|AGPA|ANPA)[A-Z0-9]{14,}+", 0, 18),
    "secret": (r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}", 0, 32),
    "endpoint": (r"(?<![A-Za-z0-9.-])(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9.:@/_-]{6,}+"
                 # a host of two or more labels of 1 to 63 characters, as one flat run: a repeated
                 # group would recurse once a label
                 r"|(?=[A-Za-z0-9-]{1,63}\.)(?![A-Za-z0-9.-]*(?:\.\.|[A-Za-z0-9-]{64}))"
                 r"[A-Za-z0-9.-]{3,}+(?<!\.):[0-9]{2,5})", 0, 14),
}


def _parts(text: Column, number: int) -> Column:
    """array<(kind, pos, gap, size, ok)> of one pattern's matches in order."""
    pattern, group, least = PATTERNS[KINDS[number]]
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    whole = value if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"),
                          value.alias("value"))

    def part(z: Column, i: Column) -> Column:
        ok = F.length(z["value"]) >= least
        if KINDS[number] == "secret":  # mixed letters and digits, else it is a word or a number
            ok = ok & z["value"].rlike("[0-9]") & z["value"].rlike("[A-Z]") \
                & z["value"].rlike("[a-z]")
        return F.struct(F.lit(number).alias("kind"), i.alias("pos"),
                        F.length(z["gap"]).cast("long").alias("gap"),
                        F.length(z["hit"]).cast("long").alias("size"),
                        F.coalesce(ok, F.lit(False)).alias("ok"))

    some = F.filter(F.transform(zipped, part), lambda p: p["size"].isNotNull())
    return F.when(text.rlike(pattern), some)


def credential_parts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Staged rows (row, id), and all valid parts (row, kind, start, end)."""
    none = F.array(F.struct(F.lit(None).cast("int").alias("kind"), F.lit(0).alias("pos"),
                            F.lit(0).cast("long").alias("gap"), F.lit(0).cast("long").alias("size"),
                            F.lit(False).alias("ok")))
    text = F.col("text")
    found = [F.coalesce(_parts(text, k), F.filter(none, lambda p: p["ok"]))
             for k in range(len(KINDS))]
    cut = (docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
           .select("id", "row", F.explode(F.concat(none, *found)).alias("p"))
           .select("id", "row", "p.*"))
    cut = stage(cut, "parts")
    running = (Window.partitionBy("row", "kind").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (cut.where(F.col("kind").isNotNull())
              .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(running))
              .where("ok").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))
    return cut.where(F.col("kind").isNull()).select("id", "row"), stage(placed, "placed")


def _is(*names: str) -> Column:
    return F.col("kind").isin([KINDS.index(n) for n in names])


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that have a row of ``right`` within SCOPE."""
    bins = right.select(F.col("row"), F.col("start").alias("other"),
                        F.explode(F.array(*[F.floor(F.col("start") / SCOPE) + k
                                            for k in (-1, 0, 1)])).alias("bin"))
    close = F.abs(F.col("start") - F.col("other")) <= SCOPE
    here = left.withColumn("bin", F.floor(F.col("start") / SCOPE))
    return (here.join(bins.withColumnRenamed("row", "r").withColumnRenamed("bin", "b"),
                      (F.col("row") == F.col("r")) & (F.col("bin") == F.col("b")) & close,
                      "left_semi").drop("bin"))


def _apart(weak: DataFrame, base: DataFrame) -> DataFrame:
    """Weak parts that overlap no base span."""
    def binned(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(F.col("row").alias(f"{prefix}row"), F.col("start").alias(f"{prefix}start"),
                         F.col("end").alias(f"{prefix}end"), *([F.col("kind")] if not prefix else []),
                         F.explode(F.sequence(F.floor(F.col("start") / SCOPE),
                                              F.floor((F.col("end") - 1) / SCOPE)))
                         .alias(f"{prefix}bin"))
    hit = (binned(weak, "").join(binned(base, "b"), (F.col("row") == F.col("brow"))
                                 & (F.col("bin") == F.col("bbin"))
                                 & (F.col("start") < F.col("bend"))
                                 & (F.col("bstart") < F.col("end")), "left_semi")
           .select("row", "kind", "start").distinct())
    return weak.join(hit, ["row", "kind", "start"], "left_anti")


def linked_parts(parts: DataFrame) -> DataFrame:
    """The weak parts to report: complementary parts co-occur with them in one scope."""
    base = parts.where(_is("assign", "access", "hex"))
    weak = stage(_apart(parts.where(_is("key", "secret", "endpoint")), base)
                 .select("row", "kind", "start", "end"), "weak")
    every = base.select("row", "kind", "start", "end").unionByName(weak)
    identifiers = every.where(_is("access", "key"))
    secrets = every.where(_is("assign", "hex", "secret"))
    return reduce(DataFrame.unionByName, [
        _near(weak.where(_is("secret")), identifiers),
        _near(weak.where(_is("key")), secrets),
        _near(_near(weak.where(_is("endpoint")), identifiers), secrets)])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex (base), base_sha256, spans, n_linked."""
    rows, parts = credential_parts(docs, id_col, text_col)
    base = parts.where(_is("assign", "access", "hex"))
    spans = base.select("row", "kind", "start", "end").unionByName(linked_parts(parts))
    listed = (spans.groupBy("row")
              .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])
    is_base = lambda s: s["kind"] < 3
    empty = F.coalesce(F.col("spans"), F.array().cast(listed.schema["spans"].dataType))
    count = lambda k: F.size(F.filter("s", lambda s: s["kind"] == k)).cast("long")
    return (rows.join(listed, "row", "left").withColumn("s", empty)
            .select(F.col("id").alias(id_col),
                    *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                    F.sha2(F.array_join(F.transform(F.filter("s", is_base), text), ",")
                           .cast("binary"), 256).alias("base_sha256"),
                    F.array_join(F.transform("s", text), ",").alias("spans"),
                    F.size(F.filter("s", lambda s: s["kind"] >= 3)).cast("long").alias("n_linked")))
