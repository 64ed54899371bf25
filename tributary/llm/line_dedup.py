"""Fuzzy line de-duplication by MinHash (operator 7).

DataFrame and SQL functions only:

1. each text is split into lines; a line's set holds the hashes of all its
   character shingles: the ``SHINGLE`` characters from every character on; a
   shorter line is one shingle;
2. a line's MinHash signature takes the least shingle hash under ``BANDS * ROWS``
   permutations (exclusive-or with constants), in bands of ROWS. The constants
   differ in the upper bits only, so the least hash of each of BINS bins, by these
   bits, gives all of them, and a shingle enters one bin in place of every permutation.
   It is one aggregate per distinct line over its shingles, which are cut from the line's
   code points and met STEP at a time. Lines of similarity 0.8 share a band with probability
   1 - (1 - 0.8 ** 3) ** 9 = 99.8 %;
3. all pairs of distinct lines under a band's key whose sizes allow a link are
   candidates, up to ``GROUP`` lines. The lines of larger bands are joined
   exactly by prefixes: in one order of the elements (rare first) two lines of
   similarity 0.8 share one of the first n - ceil(0.8 n) + 1 elements, and the
   place of the first one they share bounds their similarity, so most lines that
   merely share a phrase never meet. Where more than GROUP lines meet under an
   element, they are compared with one line of the group, and with another one
   each round while that links many; what is left unconnected is dealt out as
   pairs of blocks: of BLOCK lines, and of more (32 times the
   root) in groups of millions, so that dealing stays far below the square of
   the group;
4. candidates are verified exactly, on the whole sets: the lines themselves meet
   their pairs, as a set is many times its line, and each task makes the sets;
5. links are joined to components by distributed star contraction, and each
   component keeps its first line (by document id, then place).

Lines are identified by 64-bit hashes. The signatures' aggregate sees, by a
second hash, whether unlike lines share one; such lines are identified by the
second hash instead, so none is taken for another below a collision in 128 bits.

Defined results: lines without a character other than a space have an empty set
and are all kept. A null text counts as empty, which is one empty line. Rows
with equal ids, repeated rows too, are kept apart; null ids come first. Columns
of the input other than the two named are not read (``lines_removed`` returns
them, whatever their names). An empty table gives no rows. Texts and lines of
any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.components import components
from tributary.llm.store import broadcast_if_small, free_name, stage

SHINGLE, BANDS, ROWS, NUM, DEN = 12, 9, 3, 80, 100
#: Distinct lines under one key whose pairs are all listed at once.
GROUP = 32
#: Lines of a block, where a larger group is dealt out as pairs of blocks.
BLOCK = 1024
#: Rounds at most in which the lines of large groups are compared with one more line of their group
#: each; another round follows one that linked at least a line in WORTH.
HUB_ROUNDS, WORTH = 8, 100
#: Windows whose hashes meet the signatures' aggregate in one row: with many more, the generated
#: method would be too long for the JVM to compile.
STEP = 8
#: Bins of hashes by their upper BIN_BITS bits, at least as many as permutations.
BIN_BITS = 5
BINS = 1 << BIN_BITS
#: Bits of one of Spark's bitmaps; least and most bits of a filter (32 MB).
BITMAP, LEAST_BITS, MOST_BITS = 32768, 1 << 20, 1 << 28
_PATTERN = rf"(?s)(?=(.{{{SHINGLE}}}|\A.{{1,{SHINGLE - 1}}}(?!.)))."


def _bin(k: int) -> int:
    """The bin of a permutation: those of a band lie far apart, as near ones borrow from the same bin in
    short lines, and one common shingle would then make a band."""
    return k * 19 % BINS


def _constant(k: int) -> int:
    c = _bin(k) << (64 - BIN_BITS)
    return c - (1 << 64) if c >> 63 else c


def _coded(line: Column) -> Column:
    """The line with four bytes for each character, so that a window is found by its place."""
    return F.encode(line, "UTF-32")


def _last(coded: Column) -> Column:
    """Where the last window begins, in bytes from 1."""
    return F.greatest(F.lit(1), F.length(coded) - (4 * SHINGLE - 1))


def _window(coded: Column, at: Column) -> Column:
    """The characters of the window that begins at a byte (from 1); all of a shorter line."""
    return F.substring(coded, at, F.lit(4 * SHINGLE))


def _each_window(line: Column, value) -> Column:
    """``value`` of every window of SHINGLE characters, or of a shorter line as one; none of a line
    of spaces. The line is coded once: it enters the windows' lambda as a variable."""
    windows = F.transform(F.array(_coded(line)), lambda coded: F.transform(
        F.sequence(F.lit(1), _last(coded), F.lit(4)), lambda at: value(_window(coded, at))))
    return F.coalesce(F.when(F.trim(line) != "", F.get(windows, F.lit(0))), F.flatten(F.slice(windows, 1, 0)))


def line_shingles(line: Column) -> Column:
    """Every window of SHINGLE characters, or a shorter line as one; none of a line of spaces."""
    return _each_window(line, lambda window: F.decode(window, "UTF-32"))


def line_hashes(line: Column) -> Column:
    """The hashes of a line's character shingles, one for each window."""
    return _each_window(line, F.xxhash64)


def line_set(line: Column) -> Column:
    """The distinct hashes of a line's character shingles."""
    return F.array_distinct(line_hashes(line))


def _hash(line: Column) -> Column:
    return F.xxhash64(line)


def _second_hash(line: Column) -> Column:
    return F.xxhash64(F.lit("second"), line)


def split_lines(docs: DataFrame, id_col: str, text_col: str, clashing: DataFrame | None = None
                ) -> DataFrame:
    """(id, row, pos, line, check, key): every line of every text; ``key`` identifies its characters,
    ``check`` is its second hash. ``clashing``: (clash) keys that unlike lines share."""
    lines = (docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .select("id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .select("*", _second_hash(F.col("line")).alias("check"), _hash(F.col("line")).alias("key")))
    if clashing is None:
        return lines
    return (lines.join(broadcast_if_small(clashing), F.col("key") == F.col("clash"), "left")
            .withColumn("key", F.when(F.col("clash").isNull(), F.col("key")).otherwise(F.col("check")))
            .drop("clash"))


def _least_of_bin(j: int) -> Column:
    """The least of a row's hashes from the j-th on that are in the j-th one's bin."""
    rest = [F.expr(f"if(b{i} = b{j}, h{i}, h{j})") for i in range(j + 1, STEP)]
    return F.least(f"h{j}", *rest) if rest else F.col(f"h{j}")


def _bin_least(b: int) -> Column:
    """The least hash of a bin over rows of STEP hashes; bins are numbered in the order of the hashes,
    which are signed. Rows without a hash of the bin don't reach the aggregate: ``held`` has a bit for
    each bin that the row's hashes are in."""
    upper = b - BINS // 2
    value = f"v{STEP - 1}"
    for j in reversed(range(STEP - 1)):
        value = f"if(b{j} = {upper}, v{j}, {value})"
    return F.expr(f"min({value}) filter (where (held & shiftleft(1, {upper})) != 0)")


def signatures(lines: DataFrame) -> DataFrame:
    """Staged (key, clash, bands): of each distinct line with a shingle, the keys of its bands, and
    whether unlike lines have its key. Shingles are exploded, STEP a row, and meet in one aggregate."""
    steps = (lines.where(F.trim("line") != "").select("key", "check", _coded(F.col("line")).alias("coded"))
             .select("key", "check", "coded", _last(F.col("coded")).alias("last"))
             .select("*", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(4 * STEP))).alias("at")))
    # past the line's end the last window is met again
    places = ["at", *[F.least(F.col("at") + 4 * j, F.col("last")) for j in range(1, STEP)]]
    hashes = [F.xxhash64(_window(F.col("coded"), at)).alias(f"h{j}") for j, at in enumerate(places)]
    binned = steps.select("key", "check", *hashes).select(
        "*", *[F.shiftright(f"h{j}", 64 - BIN_BITS).cast("int").alias(f"b{j}") for j in range(STEP)])
    held = F.expr(" | ".join(f"shiftleft(1, b{j})" for j in range(STEP)))
    least = binned.select("key", "check", held.alias("held"), *[f"b{j}" for j in range(STEP)], *[
        _least_of_bin(j).alias(f"v{j}") for j in range(STEP)]).groupBy("key").agg(
        F.min("check").alias("lo"), F.max("check").alias("hi"), *[_bin_least(b).alias(f"m{b}") for b in range(BINS)])
    # the least hash under a permutation is in its bin, or in the nearest one, by exclusive-or, that has any
    least_under = [F.coalesce(*[f"m{_bin(k) ^ j}" for j in range(BINS)]).bitwiseXOR(F.lit(_constant(k)))
                   for k in range(BANDS * ROWS)]
    # a lambda's projection is split into methods; generated in line, it would be too long to be compiled
    bands = F.transform(F.array(*[F.array(*least_under[b * ROWS:(b + 1) * ROWS]) for b in range(BANDS)]),
                        lambda rows, b: F.xxhash64(b, rows))
    return stage(least.select("key", (F.col("lo") != F.col("hi")).alias("clash"), bands.alias("bands")),
                 "signatures")


def identified(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The lines under keys that no two unlike ones share, and the keys' signatures."""
    lines = split_lines(docs, id_col, text_col)
    signed = signatures(lines)
    clashing = stage(signed.where("clash").select(F.col("key").alias("clash")), "clashing")
    if clashing.isEmpty():
        return lines, signed
    lines = split_lines(docs, id_col, text_col, clashing)
    return lines, signatures(lines)


def sifted(df: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among those of ``wanted`` (staged), before an exact
    join.

    A bitmap in blocks of Spark's bitmap functions is broadcast: 16 bits for each wanted key, up to
    MOST_BITS; more keys than that only let more rows through."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(size))
    bits = (wanted.select(place.alias("place"))
            .groupBy(F.expr(f"place div {BITMAP}").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits")))
    names = {w: free_name(df.columns, w) for w in ("place", "bucket", "words")}
    words = F.transform(F.sequence(F.lit(0), F.lit(BITMAP // 64 - 1)), lambda k: F.conv(
        F.hex(F.substr("bits", 8 * k + 1, F.lit(8))), 16, -10).cast("bigint"))
    bits = stage(bits.select(F.col("bucket").alias(names["bucket"]), words.alias(names["words"])), "bitmap")
    inner = F.col(names["place"]) % BITMAP
    word = F.get(names["words"], F.floor(inner / 64).cast("int"))
    bit = 56 - (F.floor(inner / 8) % 8) * 8 + inner % 8  # bytes from the word's upper end
    found = (df.withColumn(names["place"], place)
             .join(F.broadcast(bits), F.floor(F.col(names["place"]) / BITMAP) == F.col(names["bucket"]))
             .where(F.call_function("bit_get", word, bit.cast("int")) == 1))
    return found.drop(*names.values())


def band_members(signed: DataFrame) -> DataFrame:
    """Staged (band, key, n) of the bands that n > 1 lines share."""
    entries = signed.select("key", F.explode("bands").alias("band"))
    shared = stage(entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "bands")
    return stage(sifted(entries, shared.select("band"), "band").hint("merge").join(shared, "band"), "members")


def line_sets(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Staged (key, line, size) of the distinct keys ``wanted`` (staged): a line and its set's size."""
    # not a semi-join: Catalyst would move it below the sifting, and every line would be shuffled
    found = (sifted(lines.select("key", "line"), wanted, "key").hint("merge")
             .join(wanted, "key").dropDuplicates(["key"]))
    return stage(found.select("key", "line", F.size(line_set(F.col("line"))).alias("size")), "sets")


def may_link(x: Column, y: Column) -> Column:
    """Whether two members (size, most) of one group can link: each one's size is within the other's
    reach. ``most`` bounds the partner's size by the place of the element they share."""
    return ((x["size"] * DEN >= y["size"] * NUM) & (y["size"] * DEN >= x["size"] * NUM)
            & (x["size"] <= y["most"]) & (y["size"] <= x["most"]))


def _listed(members: DataFrame, by: str) -> DataFrame:
    """(a, b): the pairs that can link, of the groups of 2 to GROUP lines; ``members`` has
    (by, key, size, most, n)."""
    small = (members.where(F.col("n").between(2, GROUP)).groupBy(by)
             .agg(F.collect_list(F.struct("key", "size", "most")).alias("group")))
    pairs = F.flatten(F.transform("group", lambda x, i: F.transform(
        F.filter(F.slice("group", F.lit(1), i), lambda y: may_link(x, y)),
        lambda y: F.struct(F.least(x["key"], y["key"]).alias("a"),
                           F.greatest(x["key"], y["key"]).alias("b")))))
    return small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def prefixes(sets: DataFrame) -> DataFrame:
    """Staged (element, key, size, most, common, n): each set's prefix, rare elements first.

    The element at place p (from 0) being the first that two sets share, they share at most
    size - p elements: ``most`` is the largest partner that this allows. ``common``: how common
    the set's elements are; ``n``: the entries under the element."""
    each = sets.select("key", "size", F.explode(line_set(F.col("line"))).alias("element"))
    often = each.groupBy("element").agg(F.count(F.lit(1)).alias("often"))
    least = F.ceil(F.col("size") * NUM / DEN).cast("int")
    ranked = (each.join(often, "element").groupBy("key", "size")
              .agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("ranked"),
                   F.avg("often").alias("common")))
    entries = ranked.select("key", "size", "common", F.posexplode(
        F.slice("ranked", F.lit(1), F.col("size") - least + 1)).alias("place", "e"))
    most = F.floor((F.col("size") - F.col("place")) * (NUM + DEN) / NUM) - F.col("size")
    entries = stage(entries.select("e.element", "key", "size", most.cast("int").alias("most"), "common")
                    .where(F.col("most") * DEN >= F.col("size") * NUM), "prefixes")
    counted = entries.groupBy("element").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return stage(entries.join(counted, "element"), "groups")


def mixed_groups(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Staged (element, n, line, component): the members (element, n, line) of the groups that hold
    lines of different components."""
    marked = stage(members.join(joined, F.col("line.key") == F.col("node"), "left")
                   .select("element", "n", "line", F.coalesce("component", "line.key").alias("component")),
                   "marked")
    mixed = (marked.groupBy("element").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where(F.col("x") < F.col("y")).select("element"))
    return stage(marked.join(mixed, "element", "left_semi"), "mixed")


def hub_pairs(mixed: DataFrame, number: int) -> DataFrame:
    """(a, b): the lines of each group that can link with one line of it, another each round, and
    are not connected to it."""
    order = F.col("line.common") if number == 0 else F.xxhash64("line.key", F.lit(number))
    hubs = mixed.groupBy("element").agg(F.max_by(F.struct("line", "component"), order).alias("hub"))
    return (mixed.join(hubs, "element")
            .where((F.col("hub.component") != F.col("component"))
                   & may_link(F.col("hub.line"), F.col("line")))
            .select(F.least("hub.line.key", "line.key").alias("a"),
                    F.greatest("hub.line.key", "line.key").alias("b")).distinct())


def unconnected_pairs(mixed: DataFrame) -> DataFrame:
    """(a, b): the pairs of a group's lines that are of different components and can link; a group
    is dealt out as pairs of blocks, which grow with its root."""
    size = F.greatest(F.lit(float(BLOCK)), 32 * F.sqrt("n"))
    blocks = F.ceil(F.col("n") / size).cast("int")
    dealt = (mixed.withColumn("block", F.pmod(F.xxhash64("line.key"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("element", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "block", "line", "component"))
    on = ["element", "lo", "hi"]
    x = dealt.where(F.col("block") == F.col("lo")).select(*on, F.struct("line.*", "component").alias("x"))
    y = dealt.where(F.col("block") == F.col("hi")).select(*on, F.struct("line.*", "component").alias("y"))
    apart = ((F.col("x.component") != F.col("y.component"))
             & ((F.col("lo") < F.col("hi")) | (F.col("x.key") < F.col("y.key"))))
    return (x.join(y, on).where(apart & may_link(F.col("x"), F.col("y")))
            .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct())


def verified_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Staged: the pairs whose sets have a Jaccard similarity of at least NUM / DEN."""
    ends = [sets.select(F.col("key").alias(k), F.col("line").alias(f"line_{k}"), F.col("size").alias(f"size_{k}"))
            for k in "ab"]
    both = pairs.join(ends[0], "a").join(ends[1], "b")
    # an intersection holds each element once, whatever repeats in the lines
    common = F.size(F.array_intersect(line_hashes(F.col("line_a")), line_hashes(F.col("line_b"))))
    # common / (sizes - common) >= NUM / DEN, with the sets met once
    alike = common * (DEN + NUM) >= (F.col("size_a") + F.col("size_b")) * NUM
    return stage(both.where(alike).select("a", "b"), "links")


def line_components(lines: DataFrame, signed: DataFrame) -> DataFrame:
    """Staged (node, component) of line keys: all similar lines that share a band are joined."""
    members = band_members(signed)
    sets = line_sets(lines, stage(members.select("key").distinct(), "wanted"))
    sized = members.join(sets.select("key", "size", F.lit(2 ** 31 - 1).alias("most")), "key")
    pairs = _listed(sized, "band")
    hot = stage(members.where(F.col("n") > GROUP).select("key").distinct(), "hot")
    if hot.isEmpty():
        return stage(components(verified_links(pairs.distinct(), sets)), "components")
    entries = prefixes(sets.join(hot, "key", "left_semi"))
    pairs = pairs.unionByName(_listed(entries, "element")).distinct()
    joined = stage(components(verified_links(pairs, sets)), "components")
    mixed = mixed_groups(entries.where(F.col("n") > GROUP).select(
        "element", "n", F.struct("key", "size", "most", "common").alias("line")), joined)
    for number in range(HUB_ROUNDS):
        more = verified_links(hub_pairs(mixed, number), sets)
        joined, worth = contracted(joined, more), more.count() * WORTH >= mixed.count()
        mixed = mixed_groups(mixed.drop("component"), joined)
        if not worth or mixed.isEmpty():
            break
    return contracted(joined, verified_links(unconnected_pairs(mixed), sets))


def contracted(joined: DataFrame, more: DataFrame) -> DataFrame:
    """Staged (node, component): ``joined`` with the links ``more``, which join whole components:
    contraction goes on with the components as nodes."""
    if more.isEmpty():
        return joined
    of = joined.withColumnRenamed("component", "c")
    ends = (more.join(of.select(F.col("node").alias("a"), F.col("c").alias("u")), "a", "left")
            .join(of.select(F.col("node").alias("b"), F.col("c").alias("v")), "b", "left")
            .select(F.coalesce("u", "a").alias("a"), F.coalesce("v", "b").alias("b")))
    met = stage(components(ends), "components")
    moved = met.select(F.col("node").alias("c"), F.col("component").alias("to"))
    alone = met.join(joined.select("node"), "node", "left_anti")
    return stage(of.join(moved, "c", "left").select("node", F.coalesce("to", "c").alias("component"))
                 .unionByName(alone.select("node", "component")), "components")


def first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                ) -> tuple[DataFrame, DataFrame]:
    """(marked, firsts): staged lines (id, row, pos, key, empty), and of each component its
    number of lines and the place (id, pos, row) of the line that stays."""
    lines, signed = identified(docs, id_col, text_col)
    marked = stage(lines.select("id", "row", "pos", "key", (F.trim("line") == "").alias("empty")), "lines")
    joined = broadcast_if_small(line_components(lines, signed))
    filled = marked.where(~F.col("empty")).select("id", "pos", "row", "key")
    firsts = (filled.join(joined, F.col("key") == F.col("node"), "left")
              .groupBy(F.coalesce("component", "key").alias("component"))
              .agg(F.count(F.lit(1)).alias("lines"), F.min(F.struct("id", "pos", "row")).alias("at")))
    return marked, firsts.select("component", "lines", "at.*")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_lines, n_kept, kept_lines (places of the lines that stay, from 0)."""
    marked, firsts = first_lines(docs, id_col, text_col)
    stays = (firsts.select("row", "pos").unionByName(marked.where("empty").select("row", "pos"))
             .groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("kept_lines")))
    per_row = marked.groupBy("row", "id").agg(F.count(F.lit(1)).alias("n_lines"))
    kept = F.coalesce("kept_lines", F.array().cast("array<int>"))
    return (per_row.join(stays, "row", "left")
            .select(F.col("id").alias(id_col), "n_lines", F.size(kept).cast("long").alias("n_kept"),
                    kept.alias("kept_lines")))


def lines_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only the lines that stay in its texts; ids must be unique and not null.

    Texts that lose every line become empty; null texts stay null."""
    name = free_name(docs.columns, "kept")
    kept = (line_dedup(docs, id_col, text_col)
            .select(F.col(id_col), F.transform("kept_lines", lambda k: k + 1).alias(name)))
    lines = F.split(F.col(text_col), "\n")
    left = F.array_join(F.transform(name, lambda k: F.element_at(lines, k)), "\n")
    return docs.join(kept, id_col).select(
        *[F.when(F.col(text_col).isNotNull(), left).alias(c) if c == text_col
          else F.col(f"`{c}`") for c in docs.columns])


def brute_force(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, list[int]]]:
    """What ``line_dedup`` must return, by comparing all pairs of lines (for tests): the
    distinct lines' shingle sets, linked exactly."""
    import re
    pattern = re.compile(_PATTERN)
    lines = [(i, k, x) for i, t in rows for k, x in enumerate((t or "").split("\n"))]
    sets = {x: frozenset(m.group(1) for m in pattern.finditer(x) if x.strip(" ")) for _, _, x in lines}
    texts = [x for x in sets if sets[x]]
    root = {x: x for x in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(texts):
        for y in texts[:k]:
            common = len(sets[x] & sets[y])
            if DEN * common >= NUM * (len(sets[x]) + len(sets[y]) - common):
                root[find(x)] = find(y)
    first: dict[str, tuple[int, int]] = {}
    for i, k, x in sorted(lines, key=lambda v: v[:2]):
        if sets[x]:
            first.setdefault(find(x), (i, k))
    stay = set(first.values())
    return [(i, len((t or "").split("\n")),
             [k for k, x in enumerate((t or "").split("\n")) if not sets[x] or (i, k) in stay])
            for i, t in rows]
