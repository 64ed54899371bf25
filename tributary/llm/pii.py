"""Personal data by rules and a semi-Markov conditional random field (operator 6).

Base spans are exact rules for four kinds (email, ip, card, phone), positions
in code points. The random field adds spans of the same kinds that the rules
miss (a phone number without a plus sign, a disguised mail address, a card with
other separators):

* zones of text around enough digits, or around a sign for "at", are cut into
  tokens; every token range that has the outline of an entity is a candidate
  segment;
* a segment is scored as a whole: its digit count, grouping, separators,
  check digit, octets, edges and the word before it, each with its kind;
* dynamic programming over a zone piece (an entity has at most ``SEGMENT``
  tokens; their number has no bound) chooses boundaries and kinds of all
  segments jointly; a segment is added when its posterior is at least
  ``CONFIDENT``, or none is;
* weights are trained here by maximum conditional likelihood (forward and
  backward sums over segmentations) on at most ``ZONES`` zones of at most
  ``SAMPLE`` texts (two documented bounds), labelled by the rules, with altered
  copies: entities with signs taken away keep their kind, numbers that break a
  rule do not.

Base spans always stay; an added span never overlaps one. Null and empty texts
have no spans. Texts are read whole, each by one task, in linear time.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import broadcast_if_small, stage

KINDS = ("email", "ip", "card", "phone")
SAMPLE, ZONES, CONFIDENT = 4000, 600, 0.9
#: Tokens of one segment, tokens of one zone piece, characters around a trigger.
SEGMENT, PIECE, AROUND = 16, 64, 24
_DIM = 1 << 13

# The rules for base spans. Digit runs start where no digit precedes,
# which is where a leftmost match starts.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules' matches, sorted."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        left = at
        while left > done and text[left - 1] in _LOCAL:
            left -= 1
        found = _DOMAIN.match(text, at + 1) if left < at else None
        if found:
            out.append((left, 0, found.end()))
            done = found.end()
        else:
            done = max(done, at)  # nothing before this sign can start a later match
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 10 <= sum(c in _DIGITS for c in m.group()) <= 15]
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_NUMBERS = re.compile(r"[0-9](?:[\x20()./+-]{0,3}[0-9]){6,}+|[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}")
_SPELLED = re.compile(r"[\[({]\x20?(?:at|AT)\x20?[\])}]"
                      r"|(?<=[A-Za-z0-9])\x20(?:at|AT)\x20[A-Za-z0-9-]+\x20(?:dot|DOT)\x20")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_SIGNS = frozenset("+()-./[]")
_DIGITS = frozenset("0123456789")


def triggers(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What may belong to an entity and is not part of a base span."""
    found = [m.span() for m in _NUMBERS.finditer(text)] if _DIGIT.search(text) else []
    if " dot " in text or " DOT " in text or any(x in text for x in ("at)", "at]", "at}", "at )", "at ]", "at }",
                                                  "AT)", "AT]", "AT}", "AT )", "AT ]", "AT }")):
        found = sorted(found + [m.span() for m in _SPELLED.finditer(text)])
    return [(s, e) for s, e in found if not any(a <= s and e <= b for a, _, b in base)]


def zones(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in triggers(text, base):
        s, e = max(0, a - AROUND), min(len(text), b + AROUND)
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def _feature(kind: int, name: str) -> int:
    return zlib.crc32(f"{kind}|{name}".encode()) % _DIM


def segments(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int, list[int]]]:
    """Candidate entities (first token, past last token, kind, features)."""
    out = []
    words = [text[s:e] for s, e in tokens]
    for i, (start, _) in enumerate(tokens):
        first = words[i]
        numeric = first[0] in _DIGITS or first in "+("
        if not (numeric or first.isalnum()):
            continue
        digits, groups, signs, marks = "", [], "", 0
        for j in range(i, min(len(tokens), i + SEGMENT)):
            w = words[j]
            if j > i and tokens[j][0] - tokens[j - 1][1] > 1:
                break
            gap = " " if j > i and tokens[j][0] > tokens[j - 1][1] else ""
            if w[0] in _DIGITS:
                digits += w
                groups.append(str(len(w)))
            elif w in _SIGNS:
                signs += w
            elif w.lower() == "at" or w == "@":
                marks += 1
            elif not (w.isalpha() or w in "_%") and w not in "{}":
                break
            signs += gap
            kinds = []
            if numeric and w[0] in _DIGITS and len(digits) >= 4 and marks == 0 \
                    and not any(x.isalpha() for x in words[i:j + 1]):
                if len(groups) == 4 and max(map(int, groups)) <= 3:
                    kinds.append(1)
                if len(digits) >= 7:
                    kinds += [2, 3]
            elif marks == 1 and first.isalnum() and w.isalpha() and len(w) > 1 and j > i + 2:
                kinds.append(0)
            if not kinds:
                continue
            end = tokens[j][1]
            body = text[start:end]
            names = ["bias", f"digits{min(len(digits), 20)}", "groups" + "-".join(groups[:8]),
                     "signs" + "".join(sorted(set(signs))),
                     f"glued{text[max(0, start - 1):start].isalnum()}"
                     f"{text[end:end + 1].isalnum()}",
                     f"more{text[end:end + 2][-1:].isdigit()}{text[max(0, start - 2):start][:1].isdigit()}",
                     "before" + (words[i - 1].lower() if i else "")]
            for kind in kinds:
                own = list(names)
                if kind == 0:
                    low = body.lower()
                    own = ["bias", f"dot{' dot ' in low or '(dot)' in low or '[dot]' in low or '.' in low}",
                           f"marked{'(at)' in low or '[at]' in low or '{at}' in low or '@' in low}",
                           f"spaces{min(6, low.count(' '))}", f"length{min(12, j - i + 1)}",
                           f"tail{min(4, len(w))}", names[4]]
                elif kind == 1:
                    parts = [x for x in re.split(r"[^0-9]+", body) if x]
                    own.append(f"octets{all(int(x) <= 255 for x in parts)}")
                elif kind == 2:
                    own.append(f"luhn{14 <= len(digits) <= 19 and luhn(digits)}")
                else:
                    own.append(f"plus{first == '+'}")
                    own.append(f"grouped{len(groups) > 1}{10 <= len(digits) <= 15}")
                out.append((i, j + 1, kind, [_feature(kind, n) for n in own]))
    return out


def _log_add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


class Field:
    """The segmentations of one zone piece: log-sums over them, and the best one."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]) -> None:
        self.size, self.segments = len(tokens), segments(text, tokens)
        self.ending: list[list[int]] = [[] for _ in range(self.size + 1)]
        for k, (_, j, _, _) in enumerate(self.segments):
            self.ending[j].append(k)

        width = max((len(f) for *_, f in self.segments), default=1)
        self.features = np.array([f + [_DIM] * (width - len(f)) for *_, f in self.segments],
                                 dtype=np.int64).reshape(-1, width)

    def scores(self, weights: np.ndarray) -> list[float]:
        """``weights`` has one more place, which is 0, for features a segment lacks."""
        return weights[self.features].sum(axis=1).tolist()

    def posteriors(self, score: list[float]) -> list[float]:
        forward = [0.0] * (self.size + 1)
        for j in range(1, self.size + 1):
            total = forward[j - 1]
            for k in self.ending[j]:
                total = _log_add(total, forward[self.segments[k][0]] + score[k])
            forward[j] = total
        backward = [0.0] * (self.size + 1)
        starting: list[list[int]] = [[] for _ in range(self.size + 1)]
        for k, (i, *_) in enumerate(self.segments):
            starting[i].append(k)
        for i in range(self.size - 1, -1, -1):
            total = backward[i + 1]
            for k in starting[i]:
                total = _log_add(total, score[k] + backward[self.segments[k][1]])
            backward[i] = total
        return [math.exp(forward[i] + score[k] + backward[j] - forward[self.size])
                for k, (i, j, _, _) in enumerate(self.segments)]

    def best(self, score: list[float]) -> list[int]:
        """The segments of the best segmentation."""
        table, back = [0.0] * (self.size + 1), [-1] * (self.size + 1)
        for j in range(1, self.size + 1):
            table[j] = table[j - 1]
            for k in self.ending[j]:
                value = table[self.segments[k][0]] + score[k]
                if value > table[j]:
                    table[j], back[j] = value, k
        out, j = [], self.size
        while j > 0:
            k = back[j]
            if k >= 0:
                out.append(k)
                j = self.segments[k][0]
            else:
                j -= 1
        return out[::-1]


def pieces(text: str, zone: tuple[int, int]):
    """Token lists of a zone, at most PIECE tokens each (positions in the text)."""
    tokens = [m.span() for m in _TOKEN.finditer(text, *zone)]
    for k in range(0, len(tokens), PIECE - SEGMENT):
        yield tokens[k:k + PIECE]
        if k + PIECE >= len(tokens):
            break


def added_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray | None
                ) -> list[tuple[int, int, int]]:
    if weights is None:
        return []
    taken, out = sorted((s, e) for s, _, e in base), []
    free = lambda s, e: all(e <= a or b <= s for a, b in taken)
    for zone in zones(text, base):
        for tokens in pieces(text, zone):
            field = Field(text, tokens)
            if not field.segments:
                continue
            score = field.scores(weights)
            chosen = field.best(score)
            sure = field.posteriors(score) if chosen else []
            for k in chosen:
                i, j, kind, _ = field.segments[k]
                s, e = tokens[i][0], tokens[j - 1][1]
                if sure[k] >= CONFIDENT and free(s, e):
                    out.append((s, kind, e))
                    taken.append((s, e))
    return out


def _altered(zone: str, spans: list[tuple[int, int, int]], rng: random.Random):
    """Copies of a training zone with its one entity altered: (text, spans)."""
    if len(spans) != 1:
        return
    (s, kind, e), = spans
    head, body, tail = zone[:s], zone[s:e], zone[e:]
    digits = re.sub(r"[^0-9]", "", body)

    def made(new: str, same: bool):
        return head + new + tail, [(s, kind, s + len(new))] if same else []

    if kind == 0:
        at = rng.choice((" at ", " [at] ", "(at)", " (at) ", "[at]"))
        dot = rng.choice((" dot ", ".", " [dot] ", "(dot)", "."))
        yield made(body.replace("@", at).replace(".", dot), True)
    elif kind == 1:
        yield made(body.replace(".", rng.choice(("[.]", "(.)"))), True)
        yield made(".".join(str(256 + rng.randrange(700)) for _ in range(4)), False)
    elif kind == 2:
        groups = [digits[k:k + 4] for k in range(0, len(digits), 4)]
        yield made(rng.choice((".", "/")).join(groups), True)
        yield made(digits[:-1] + str((int(digits[-1]) + 1 + rng.randrange(8)) % 10), False)
    else:
        yield made(re.sub(r"^\+[0-9]{0,3}[\x20-]?(?=[(0-9])", "", body), True)
        yield made(digits, False)
        yield made("".join(rng.choice("0123456789") for _ in range(rng.choice((7, 8, 9, 16)))), False)


def train(sample: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 40
          ) -> np.ndarray | None:
    """Weights from (zone, base spans) rows; None without any entity."""
    rng, rows = random.Random(0), []
    for zone, spans in sorted(sample):
        rows.append((zone, spans))
        rows.extend(_altered(zone, spans, rng))
    fields, gold = [], np.zeros(_DIM + 1)
    for zone, spans in rows:
        tokens = [m.span() for m in _TOKEN.finditer(zone)]
        field = Field(zone, tokens)
        place = {(tokens[i][0], kind, tokens[j - 1][1]): f for i, j, kind, f in field.segments}
        if field.segments:
            fields.append(field)
            for x in spans:
                np.add.at(gold, place.get(x, []), 1.0)
    if not gold.any():
        return None
    weights, speed = np.zeros(_DIM + 1), np.full(_DIM + 1, 1e-6)
    for _ in range(rounds):
        gradient = gold - 0.05 * weights
        for field in fields:
            sure = np.array(field.posteriors(field.scores(weights)))
            np.subtract.at(gradient, field.features, sure[:, None])
        gradient[_DIM] = 0.0
        speed += gradient * gradient
        weights += 0.5 * gradient / np.sqrt(speed)
    return weights


def _sample(docs: DataFrame, id_col: str, text_col: str) -> list[tuple[str, list]]:
    ids = stage(docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
                .orderBy(F.xxhash64("id"), "id").limit(SAMPLE), "sample")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(broadcast_if_small(ids), "id").select("text"))

    def cut(batches):
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                text = text or ""
                base = base_spans(text)
                around = zones(text, []) + [(max(0, s - AROUND), min(len(text), e + AROUND))
                                            for s, k, e in base if k == 0]
                for s, e in around:
                    if e - s <= 8 * AROUND:
                        own = [(a - s, k, b - s) for a, k, b in base if s <= a and b <= e]
                        found.append((text[s:e], [x for pair in own for x in pair]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([z for z, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.list_(pa.int64()))], names=["zone", "spans"])

    rows = (texts.mapInArrow(cut, "zone string, spans array<long>").distinct()
            .orderBy(F.xxhash64("zone"), "zone").limit(ZONES).collect())
    return [(r.zone, [tuple(r.spans[k:k + 3]) for k in range(0, len(r.spans), 3)]) for r in rows]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    source = docs.select(F.col(id_col), F.col(text_col))
    weights = train(_sample(docs, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scan(batches):
        weights = shared.value
        for batch in batches:
            counts, digest, spans, added = [[] for _ in KINDS], [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                more = added_spans(text, base, weights) if text else []
                for k, column in enumerate(counts):
                    column.append(sum(x[1] == k for x in base))
                digest.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(sorted(base + more)))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(digest, pa.string()), pa.array(spans, pa.string()),
                 pa.array(added, pa.int64())],
                names=[batch.schema.names[0], *[f"n_{k}" for k in KINDS], "base_sha256", "spans",
                       "n_added"])

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(scan, f"`{id_col}` {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                             + ", base_sha256 string, spans string, n_added long")
