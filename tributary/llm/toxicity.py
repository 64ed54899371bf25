"""Toxicity by a learned lexicon, Levenshtein automata and context windows (operator 4).

1. Lexicon: over all labelled training texts, the number of toxic and of other
   texts that hold each word, or each stem (a word's first letters), is
   counted by Spark. All terms whose toxic share is high beyond chance (G test)
   are significant; the lexicon leaves out those that a shorter stem implies.
2. Matching: all significant words of some length are a trie, also those that a
   stem implies. Words that match exactly are looked up; misspelled words are
   found by the Levenshtein automaton of one edit run on the trie,
   determinised as words demand (a state is the set of trie nodes
   reachable with each number of edits). A word is matched once per task
   however often it occurs.
3. Context: each match is weighed in a window of words around it: matches that
   stand inside quotation marks count apart from the others, and matches that
   stand together count as a cluster.
4. Score: logistic regression on these counts, fitted on at most
   ``SAMPLE`` labelled training rows (a documented bound; the lexicon's counts
   use all of them).

Null and empty texts have no matches and get the score of a text without any.
Rows with a null id are scored and never learned from. Of repeated label rows
of an id the largest label counts; without usable labels every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.store import broadcast_if_small, free_name, stage

SAMPLE = 20_000
#: Toxic texts that must hold a term, and the G statistic it must reach.
SUPPORT, SIGNIFICANT = 4, 20.0
STEMS = (4, 5, 6)
#: Words on each side that make a match's context.
CONTEXT = 8
FUZZY_LENGTH = 5
THRESHOLD = 0.3
_MEMO = 1 << 18
_EDGE = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                          *range(0x7B, 0x7F)])) + "«»„“”‘’‚‹›…–—¡¿"
_QUOTES = frozenset("\"«»„“”‹›")
FEATURES = ("bias", "words", "stems", "fuzzy", "quoted", "cluster", "weight", "density")


def _terms(word: str) -> list[str]:
    """The lexicon keys of a bare word: itself, and its stems marked by a star."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)] if len(word) > 1 else []


class Matcher:
    """Exact and stem matches of words against the lexicon, and one-edit matches against all
    significant words (by default the lexicon's)."""

    def __init__(self, lexicon: dict[str, float], significant: dict[str, float] | None = None
                 ) -> None:
        self.lexicon = lexicon
        self.weights = {**(significant or {}), **lexicon}
        strong = sorted(w for w in self.weights if "*" not in w and len(w) >= FUZZY_LENGTH)
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for w in strong:
            node = 0
            for ch in w:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][ch]
            self.term[node] = w
        self.alphabet = {ch for edges in self.children for ch in edges}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})
        self.memo: dict[str, tuple[str, str] | None] = {}

    def _state(self, nodes: set[tuple[int, int]]) -> int:
        closed = set(nodes)
        for node, edits in nodes:  # a letter of the term is missing in the word
            if edits == 0:
                closed.update((c, 1) for c in self.children[node].values())
        key = frozenset(p for p in closed if p[1] == 0 or (p[0], 0) not in closed)
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, ch: str) -> int:
        known = self.moves[state]
        if ch not in known:
            nodes = set()
            for node, edits in self.sets[state]:
                children = self.children[node]
                if ch in children:
                    nodes.add((children[ch], edits))
                if edits == 0:
                    nodes.add((node, 1))  # a letter too many
                    nodes.update((c, 1) for c in children.values())  # another letter
            known[ch] = self._state(nodes) if nodes else -1
        return known[ch]

    def fuzzy(self, word: str) -> str | None:
        state = self.start
        for ch in word:
            state = self._move(state, ch if ch in self.alphabet else "\0")
            if state < 0:
                return None
        found = [self.term[n] for n, _ in self.sets[state] if self.term[n]]
        return min(found) if found else None

    def match(self, token: str) -> tuple[str, str] | None:
        """(kind, term) of a white-space token, or None."""
        if token in self.memo:
            return self.memo[token]
        if len(self.memo) >= _MEMO or len(self.sets) >= _MEMO:
            self._reset()
        word, found = token.strip(_EDGE), None
        if word in self.lexicon:
            found = ("words", word)
        elif len(word) > 1:
            stem = next((s for s in _terms(word)[:0:-1] if s in self.lexicon), None)
            if stem:
                found = ("stems", stem)
            elif len(word) >= FUZZY_LENGTH - 1 and (near := self.fuzzy(word)):
                found = ("fuzzy", near)
        self.memo[token] = found
        return found

    def features(self, text: str) -> list[float]:
        tokens = text.lower().split()
        memo, match = self.memo, self.match
        seen = {}
        for t in set(tokens):
            found = memo[t] if t in memo else match(t)
            if found:
                seen[t] = found
        if not seen:
            return [1.0, *[0.0] * (len(FEATURES) - 1)]
        count = {"words": 0, "stems": 0, "fuzzy": 0, "quoted": 0}
        weight, at = 0.0, [i for i, t in enumerate(tokens) if t in seen]
        cluster, low = 0, 0
        for k, i in enumerate(at):
            while at[low] < i - CONTEXT:
                low += 1
            cluster = max(cluster, k - low)
            kind, term = seen[tokens[i]]
            before = sum(_QUOTES.intersection(t).__len__() for t in tokens[max(0, i - CONTEXT):i])
            opened = bool(_QUOTES.intersection(tokens[i][:1])) or before % 2 == 1
            closed = any(not _QUOTES.isdisjoint(t[-2:]) for t in tokens[i:i + CONTEXT])
            if opened and closed:
                count["quoted"] += 1
            else:
                count[kind] += 1
                weight += self.weights[term]
        return [1.0, *(float(np.log1p(count[k])) for k in ("words", "stems", "fuzzy", "quoted")),
                float(np.log1p(cluster)), float(np.log1p(weight)),
                float(np.log1p(100.0 * len(at) / len(tokens)))]


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Rows that are never learned from; a null id is one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")),
                             F.lit(folds)) == fold, F.lit(True))


def _count_terms(texts: DataFrame) -> DataFrame:
    """(term, n): texts that hold each term."""
    def scan(batches):
        total = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                              pa.array(list(total.values()), pa.int64())],
                                             names=["term", "n"])
            total.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for t in {t for w in {w.strip(_EDGE) for w in set((text or "").lower().split())}
                          for t in _terms(w)}:
                    total[t] = total.get(t, 0) + 1
            if len(total) >= _MEMO:
                yield flush()
        yield flush()

    return (texts.mapInArrow(scan, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def significant_terms(labelled: DataFrame) -> dict[str, float]:
    """{term: weight} of every term that passes the G test, from staged (text, toxic) rows."""
    sizes = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    toxic = stage(_count_terms(labelled.where("toxic = 1").select("text"))
                  .where(F.col("n") >= SUPPORT).withColumnRenamed("n", "t"), "toxic_terms")
    other = _count_terms(labelled.where("toxic = 0").select("text"))
    both = (toxic.join(other, "term", "left")
            .select("term", "t", F.coalesce("n", F.lit(0)).alias("c")))
    t, c, prior = F.col("t"), F.col("c"), bad / (bad + good)
    share = t / (t + c)
    gain = 2 * (t * F.log(share / prior)
                + F.when(c > 0, c * F.log((1 - share) / (1 - prior))).otherwise(0.0))
    found = (both.where((share > max(0.5, 2 * prior)) & (gain >= SIGNIFICANT))
             .select("term", F.log((t + 0.5) * (good + 1) / ((c + 0.5) * (bad + 1))).alias("weight"))
             .toArrow().to_pydict())
    return dict(sorted(zip(found["term"], found["weight"])))


def without_implied(significant: dict[str, float]) -> dict[str, float]:
    """The terms that no shorter stem of at least nearly their weight implies."""
    return {t: w for t, w in significant.items()
            if not any(s != t and significant.get(s, -1.0) >= w - 1.0
                       for s in (t[:k] + "*" for k in STEMS if len(t.rstrip("*")) > k))}


def with_features(docs: DataFrame, significant: dict[str, float], text_col: str, name: str
                  ) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(significant)

    def scan(batches):
        matcher = Matcher(without_implied(shared.value), shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            rows = [matcher.features(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.float64()))],
                names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields,
                                               T.StructField(name, T.ArrayType(T.DoubleType()))]))


def fit(rows: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, L2 on all weights but the bias."""
    weights = np.zeros(rows.shape[1])
    ridge = np.full(rows.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (p - labels) + ridge * weights
        curvature = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a score column appended, and that column's name."""
    name = free_name(docs.columns, "score")
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")))
    marks = stage(marks.where(~held_out("id")), "labels")
    labelled = stage(docs.select(F.col(id_col).alias("id"),
                                 F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                     .join(broadcast_if_small(marks), "id"), "labelled")
    significant = significant_terms(labelled)
    sample = (with_features(labelled.select("id", "toxic", "text"), significant, "text", "features")
              .select("id", "toxic", "features")
              .orderBy(F.xxhash64("id"), "id", "features").limit(SAMPLE).toArrow())
    found = np.array(sample.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    truth = sample.column("toxic").to_numpy().astype(float)
    usable = len(truth) and 0 < truth.sum() < len(truth)
    weights = fit(found, truth) if usable else np.r_[-800.0, np.zeros(len(FEATURES) - 1)]
    given = with_features(docs, significant, text_col, name)
    total = sum((F.element_at(F.col(name), k + 1) * float(w) for k, w in enumerate(weights)),
                F.lit(0.0))
    return given.withColumn(name, 1 / (1 + F.exp(-total))), name


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score (0 to 1), predicted (1 if score >= THRESHOLD)."""
    scored, name = toxicity(docs.select(id_col, text_col), labels, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))


def toxic_removed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored under THRESHOLD, with all their columns."""
    scored, name = toxicity(docs, labels, id_col, text_col)
    return scored.where(F.col(name) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
