"""Secret scan: fixed patterns, and probabilistic automata inferred from what they find.

The patterns' findings are labelled credentials. Per kind a stochastic automaton is inferred
from a bounded sample of them: a prefix tree of their symbols, whose states are merged in
breadth-first order whenever the Hoeffding bound cannot tell their futures apart. A symbol is
a character class (digit, a-f, g-z, A-F, G-Z) or the punctuation mark itself. Then every
candidate of the corpus is scored: all runs of at least 8 characters of the assign pattern's
character set (letters, digits, ``+/_.=-``) that are clear of base spans, whatever they are made
of; full stops at the end belong to the sentence. A candidate's format likelihood is the mean log-probability per symbol, its end included,
under a kind's automaton, less that under an automaton of the corpus's other candidates. It is
flagged when it is about as likely as the labelled ones and more likely than an ordinary string.
Length is judged by the automaton's end probabilities alone. Both automata are smoothed, so small
samples, and none, give defined scores. Runs of fewer than 8 characters are not candidates.

Two passes over whole texts: the first keeps, per task, the credentials and ordinary strings with
the smallest hashes, so that the samples are those of the whole corpus and bounded; the second
finds and scores.

Defined results: a null or empty text has no span; overlapping candidates of base spans are
dropped; repeated rows get equal results; without any finding nothing is learnt and only base
spans (none) remain; an empty table gives no rows. Positions are code points.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.common import cut, read_table

KINDS = ("assign", "access", "hex")
SAMPLE = 400               # labelled credentials per kind that an automaton is inferred from
PLAIN_SAMPLE = 20_000      # ordinary candidates for the background automaton
SAMPLE_CHARS = 256         # longer strings are not learnt from (they are scored like all others)
MIN_CANDIDATE = 8
ALPHABET = 11              # symbols: five character classes and six marks
HOEFFDING = 0.05           # confidence of the merge test
SLACK = 0.15               # nats per symbol below the least likely labelled credential
MIN_GAIN = 0.25            # nats per symbol above the background

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}[A-Za-z0-9+/_=-]" % (MIN_CANDIDATE - 1))

_SYMBOLS = str.maketrans("0123456789" "abcdef" "ghijklmnopqrstuvwxyz" "ABCDEF" "GHIJKLMNOPQRSTUVWXYZ",
                         "0" * 10 + "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind index, end, credential) of the fixed patterns."""
    out = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                out.append((m.start(), 1, m.end(), m[0]))
    for m in _HEX.finditer(text):
        out.append((m.start(), 2, m.end(), m[0]))
    return sorted(out)


def candidates(text: str, taken: list) -> list[tuple[int, int, str]]:
    """(start, end, string) of runs of credential characters, clear of base spans."""
    found = [(m.start(), m.end(), m[0]) for m in _CANDIDATE.finditer(text)]
    return [c for c in found if not any(c[0] < e and b < c[1] for b, _, e, _ in taken)] if taken else found


# --- inference --------------------------------------------------------------------------

@dataclass
class _State:
    count: int = 0                      # strings that pass here
    end: int = 0                        # strings that end here
    to: dict = field(default_factory=dict)
    seen: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Automaton:
    """Per state: symbol → (next state, log-probability), and the log-probability of ending."""
    moves: tuple
    ends: tuple
    miss: float
    floor: float                        # least mean log-probability of the strings it was inferred from

    def mean_log(self, symbols: str) -> float:
        state, total = 0, 0.0
        for c in symbols:
            step = self.moves[state].get(c) if state is not None else None
            state, p = step if step else (None, self.miss)
            total += p
        total += self.ends[state] if state is not None else self.miss
        return total / (len(symbols) + 1)


def _differ(f1: int, n1: int, f2: int, n2: int) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / HOEFFDING)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(f1 / n1 - f2 / n2) > bound


def _compatible(a: _State, b: _State) -> bool:
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if not a.count or not b.count:
            continue
        if _differ(a.end, a.count, b.end, b.count):
            return False
        for c in a.to.keys() | b.to.keys():
            if _differ(a.seen.get(c, 0), a.count, b.seen.get(c, 0), b.count):
                return False
            if c in a.to and c in b.to:
                stack.append((a.to[c], b.to[c]))
    return True


def _fold(a: _State, b: _State) -> None:
    """Adds the tree below ``b`` to ``a``."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        a.count += b.count
        a.end += b.end
        for c, child in b.to.items():
            a.seen[c] = a.seen.get(c, 0) + b.seen[c]
            if c in a.to:
                stack.append((a.to[c], child))
            else:
                a.to[c] = child


def infer(strings: list[str]) -> Automaton:
    """Automaton of symbol strings; of none, all symbols and the end are equally likely."""
    root = _State()
    for s in sorted(strings):
        state = root
        state.count += 1
        for c in s:
            state.seen[c] = state.seen.get(c, 0) + 1
            state = state.to.setdefault(c, _State())
            state.count += 1
        state.end += 1
    red, at = [root], 0
    while at < len(red):                # children of red states, in breadth-first order
        state = red[at]
        at += 1
        for c in sorted(state.to):
            child = state.to[c]
            if any(child is r for r in red):
                continue
            for r in red:
                if _compatible(r, child):
                    state.to[c] = r
                    _fold(r, child)
                    # what was folded in may hang new children below states already visited
                    at = min(at, next(i for i, x in enumerate(red) if x is r))
                    break
            else:
                red.append(child)
    number = {id(s): i for i, s in enumerate(red)}
    moves, ends = [], []
    for s in red:
        total = s.end + sum(s.seen.values()) + 0.5 * (ALPHABET + 1)
        moves.append({c: (number[id(t)], math.log((s.seen[c] + 0.5) / total)) for c, t in s.to.items()})
        ends.append(math.log((s.end + 0.5) / total))
    miss = math.log(0.5 / (len(strings) + 0.5 * (ALPHABET + 1)))
    raw = Automaton(tuple(moves), tuple(ends), miss, 0.0)
    return Automaton(raw.moves, raw.ends, miss, min((raw.mean_log(s) for s in strings), default=0.0))


@dataclass(frozen=True)
class Formats:
    """Per kind its automaton (or None), and the background's."""
    kinds: tuple
    plain: Automaton

    def kind_of(self, symbols: str) -> int | None:
        """The kind whose format the string has, if any."""
        best, found = -math.inf, None
        plain = self.plain.mean_log(symbols)
        for k, a in enumerate(self.kinds):
            if a is None:
                continue
            p = a.mean_log(symbols)
            if p >= a.floor - SLACK and p - plain >= MIN_GAIN and p > best:
                best, found = p, k
        return found


class Smallest:
    """The ``size`` distinct strings with the smallest hashes."""

    def __init__(self, size: int):
        self.size, self.held, self.limit = size, {}, 1 << 32

    def add(self, value: str) -> None:
        if len(value) > SAMPLE_CHARS:
            return
        mark = zlib.crc32(value.encode())
        if mark < self.limit:
            self.held[value] = mark
            if len(self.held) >= 2 * self.size:
                self.trim()

    def trim(self) -> list[tuple[int, str]]:
        least = sorted((m, v) for v, m in self.held.items())[:self.size]
        if len(least) == self.size:
            self.held, self.limit = {v: m for m, v in least}, least[-1][0] + 1
        return least


PLAIN = len(KINDS)


def fit(docs: DataFrame) -> Formats:
    """From (doc_id, text). Samples are the strings with the smallest hashes; the background are
    candidates, i.e. strings that no pattern calls a credential."""
    sizes = [SAMPLE] * len(KINDS) + [PLAIN_SAMPLE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [Smallest(n) for n in sizes]
        for batch in batches:
            for text in batch.column(1):
                t = text.as_py() or ""
                base = base_spans(t)
                for _, kind, _, value in base:
                    samples[kind].add(value)
                for _, _, value in candidates(t, base):
                    samples[PLAIN].add(value)
        for kind, sample in enumerate(samples):
            least = sample.trim()
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(least), pa.int32()), pa.array([m for m, _ in least], pa.int64()),
                 pa.array([v for _, v in least], pa.string())], names=["kind", "mark", "value"])

    each = cut(docs.sparkSession, docs.select("doc_id", "text").mapInArrow(run, "kind int, mark long, value string"),
               "secret-samples").distinct()
    strings = [[r["value"].translate(_SYMBOLS) for r in each.filter(F.col("kind") == k).orderBy("mark", "value")
                .limit(n).collect()] for k, n in enumerate(sizes)]
    return Formats(tuple(infer(x) if x else None for x in strings[:PLAIN]), infer(strings[PLAIN]))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text) → doc_id, base and learned: arrays of (start, kind, stop)."""
    shared = spark.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats = shared.value
        kind_of = lru_cache(maxsize=100_000)(formats.kind_of)
        learns = any(formats.kinds)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            base, learned = [], []
            for text in batch.column(1):
                t = text.as_py() or ""
                b = base_spans(t)
                base.append([{"start": s, "kind": k, "stop": e} for s, k, e, _ in b])
                scored = ((s, e, kind_of(v.translate(_SYMBOLS))) for s, e, v in candidates(t, b)) if learns else ()
                learned.append([{"start": s, "kind": k, "stop": e} for s, e, k in scored if k is not None])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, spans), pa.array(learned, spans)],
                                             names=["doc_id", "base", "learned"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = "array<struct<start:int,kind:int,stop:int>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {found}, learned {found}")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["stop"])), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned spans are named ``like_<kind>``."""
    found = scan(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"),
        F.get(names, s["kind"]).alias("name")))
    more = F.transform("learned", lambda s: F.struct(
        s["start"].alias("start"), (s["kind"] + len(KINDS)).alias("kind"), s["stop"].alias("stop"),
        F.concat(F.lit("like_"), F.get(names, s["kind"])).alias("name")))
    def of_kind(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts,
                        F.sha2(_joined(F.array_sort(base)).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat(base, more))).alias("spans"))
