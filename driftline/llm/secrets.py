"""Secret scans: fixed rules, and automata inferred from credentials that those rules label."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import materialise, read_table

KINDS = ("assign", "access", "hex")
#: The base rules, and the least length of what each finds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: A candidate is a run of these characters, as long as it goes, without punctuation at its ends but for padding.
_CANDIDATE = re.compile(r"(?<![^\W_])[A-Za-z0-9+/_-](?:[A-Za-z0-9+/_.-]*[A-Za-z0-9+/_-])?(?:={1,2}|(?![^\W_]))")
CANDIDATE_LEAST = min(LEAST.values())
#: Labelled credentials of each kind that an automaton is inferred from, and other runs, those of least hash; longer ones are not taken.
SAMPLE_ROWS, BACKGROUND_ROWS, SAMPLE_LENGTH = 1000, 4000, 80
#: Confidence parameter of the test that two states behave alike.
ALPHA = 0.05
#: Every so many values of a sample set a threshold instead of an automaton.
HELD_OUT = 4
#: Share of held-out credentials that a threshold may miss, and of other held-out runs that it may let pass.
MISS, FALSE_ALARMS = 0.05, 0.001

_PIECES = re.compile(r"[A-Za-z0-9]+|.", re.S)


def _piece_class(piece: str) -> str:
    """What the letters and digits between two other characters are, taken together."""
    digits = not piece.isalpha()
    if not digits:
        return "a" if piece.islower() else "A" if piece.isupper() else "C" if piece[1:].islower() else "M"
    if piece.isdigit():
        return "0"
    plain = not set(piece.lower()) - set("0123456789abcdef")
    return ("h" if plain else "b") if piece.islower() else ("H" if plain else "U") if piece.isupper() else "x"


def _symbols(text: str) -> str:
    """The format of a text: for each letter or digit the class of its piece, other characters as they are."""
    return "".join([_piece_class(x) * len(x) if x[0].isalnum() else x for x in _PIECES.findall(text)])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of what the rules find, by start and then kind as listed; ends exclusive."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in _HEX_RUNS(text)]
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


#: Runs of hexadecimal digits are as long as they go, so that the short ones need not be looked at.
_HEX_RUNS = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}").finditer


def credential(text: str, span: tuple[int, int, str]) -> str:
    """The value in a base span: without the name before it."""
    a, b, kind = span
    return _ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b]


@dataclass
class Automaton:
    """A deterministic automaton with the logarithms of the probabilities of symbols and of ending in each state."""

    steps: list[dict[str, tuple[int, float]]]
    ends: list[float]
    unseen: float

    def loglik(self, symbols: str) -> float:
        """Log-likelihood of a symbol and of the end; where the automaton has no step, that of an unseen symbol, staying."""
        state, total = 0, 0.0
        for s in symbols:
            step = self.steps[state].get(s)
            if step is None:
                total += self.unseen
            else:
                state = step[0]
                total += step[1]
        return (total + self.ends[state]) / (len(symbols) + 1)


def infer(samples: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge compatible states of the samples' prefix tree.

    States are taken in breadth-first order. Each is compared with those kept so far: if
    neither the share of words that end there, nor the share of any symbol, nor those of
    the states after it differ by more than Hoeffding's bound, it is merged and what
    follows is folded together; otherwise it is kept.
    """
    children: list[dict[str, int]] = [{}]
    count, end, through = [0], [0], [Counter()]
    for word in samples:
        at = 0
        count[0] += 1
        for s in word:
            through[at][s] += 1
            if s not in children[at]:
                children[at][s] = len(children)
                children.append({})
                count.append(0)
                end.append(0)
                through.append(Counter())
            at = children[at][s]
            count[at] += 1
        end[at] += 1
    width = math.sqrt(0.5 * math.log(2 / alpha))

    def differs(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > width * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def alike(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            if differs(end[a], count[a], end[b], count[b]):
                return False
            if any(differs(through[a][s], count[a], through[b][s], count[b]) for s in through[a].keys() | through[b].keys()):
                return False
            todo += [(children[a][s], children[b][s]) for s in children[a].keys() & children[b].keys()]
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            count[a] += count[b]
            end[a] += end[b]
            through[a].update(through[b])
            for s, t in children[b].items():
                if s in children[a]:
                    todo.append((children[a][s], t))
                else:
                    children[a][s] = t

    kept, queue = [0], [(0, s) for s in sorted(children[0])]
    while queue:
        parent, s = queue.pop(0)
        state = children[parent][s]
        if state in kept:
            continue
        twin = next((k for k in kept if alike(k, state)), None)
        if twin is None:
            kept.append(state)
            queue += [(state, x) for x in sorted(children[state])]
        else:
            children[parent][s] = twin
            fold(twin, state)
            queue += [(k, x) for k in kept for x in sorted(children[k]) if children[k][x] not in kept and (k, x) not in queue]
    number = {k: i for i, k in enumerate(kept)}
    steps, ends = [], []
    for k in kept:
        total = count[k] + len(through[k]) + 1
        steps.append({s: (number[t], math.log((through[k][s] + 1) / total)) for s, t in children[k].items() if t in number})
        ends.append(math.log((end[k] + 1) / total))
    return Automaton(steps, ends, math.log(1 / (len(samples) + 2)))


@dataclass
class Grammar:
    """An automaton and threshold for each kind of credential, against one for other runs."""

    kinds: dict[str, tuple[Automaton, float]]
    background: Automaton

    def score(self, value: str) -> tuple[float, str]:
        """The highest log-likelihood ratio to the background above its threshold, a symbol, and its kind."""
        return self.score_format(_symbols(value))

    def score_format(self, symbols: str) -> tuple[float, str]:
        other = self.background.loglik(symbols)
        return max(((a.loglik(symbols) - other - t, k) for k, (a, t) in self.kinds.items()), default=(-1.0, ""))


def _parted(values: list[str]) -> tuple[list[str], list[str]]:
    """Formats to learn from, and those held out; of a few values, all are both."""
    found = [_symbols(x) for x in values]
    if len(found) < 5 * HELD_OUT:
        return found, found
    return [x for k, x in enumerate(found) if k % HELD_OUT], found[::HELD_OUT]


def infer_grammar(credentials: dict[str, list[str]], background: list[str]) -> Grammar:
    """Automata of labelled credentials by kind, and a threshold of the likelihood ratio for each.

    A threshold lies half-way between what all but ``MISS`` of the held-out credentials reach
    and what all but ``FALSE_ALARMS`` of the other held-out runs stay below, so formats of
    other lengths and separators than the sample's pass too. The other runs may hold some
    unnamed credentials; where these bring the two to overlap, the former decides. A
    threshold is 0 at least.
    """
    others, other_held_out = _parted(background)
    other, kinds = infer(others), {}
    for kind, values in sorted(credentials.items()):
        samples, held_out = _parted(values)
        automaton = infer(samples)
        automaton.unseen = min(automaton.unseen, other.unseen - 3)  # what neither has seen is no credential
        ratios = lambda words: sorted(automaton.loglik(x) - other.loglik(x) for x in words)  # noqa: B023, E731
        known, alarms = ratios(held_out), ratios(other_held_out) or [0.0]
        high, low = known[int(MISS * len(known))], alarms[max(0, math.ceil((1 - FALSE_ALARMS) * len(alarms)) - 1)]
        kinds[kind] = (automaton, max(0.0, (min(low, high) + high) / 2))
    return Grammar(kinds, other)


def candidate_runs(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, bool]]:
    """``start, end, apart`` of all runs but those within one base span; ``apart`` ones meet none. Both lists are in order."""
    found, k, reach = [], 0, 0
    spans = sorted({(a, b) for a, b, _ in base})
    upto = []  # the furthest end of the spans up to each
    for _, b in spans:
        reach = max(reach, b)
        upto.append(reach)
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if b - a < CANDIDATE_LEAST:
            continue
        while k < len(spans) and spans[k][0] < b:
            k += 1  # spans before k start before the run's end
        inside = k > 0 and upto[k - 1] > a
        if not inside:
            found.append((a, b, True))
        else:
            j = k
            while j > 0 and upto[j - 1] > a and not (spans[j - 1][0] <= a and spans[j - 1][1] >= b):
                j -= 1
            if not (j > 0 and upto[j - 1] > a):
                found.append((a, b, False))
    return found


def find_candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, base, runs`` for each row: base spans, with the credential in each, and candidate runs that reach beyond them.

    Runs are all those of ``CANDIDATE_LEAST`` characters or more; their kind is empty, or
    ``beside`` where they meet a base span.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = batch.slice(k, 256)
                bases, runs = [], []
                for value in rows.column(1):
                    whole = value.as_py() or ""
                    base = base_spans(whole)
                    bases.append([{"start": a, "end": b, "kind": kind, "value": credential(whole, (a, b, kind))} for a, b, kind in base])
                    runs.append([{"start": a, "end": b, "kind": "" if apart else "beside", "value": whole[a:b]} for a, b, apart in candidate_runs(whole, base)])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(bases, kind_of), pa.array(runs, kind_of)], names=["doc_id", "base", "runs"])

    kind_of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string())]))
    spans = "array<struct<start:long,end:long,kind:string,value:string>>"
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, base {spans}, runs {spans}")


def _sample(rows: DataFrame, column: str, kinds: tuple[str, ...], most: int) -> dict[str, list[str]]:
    """Up to ``most`` different values of each kind, those of least hash.

    Values are some millions or more, so their number is estimated first, and those whose
    hash is too high to be taken stay out of the shuffle.
    """
    values = rows.select(F.explode(column).alias("x")).select("x.kind", "x.value").where(F.length("value") <= SAMPLE_LENGTH)
    numbers = {r.kind: r.n for r in values.groupBy("kind").agg(F.approx_count_distinct("value").alias("n")).collect()}
    out = {}
    for kind in kinds:
        share = min(1.0, 4 * most / max(numbers.get(kind, 0), 1))
        low = values.where((F.col("kind") == kind) & (F.xxhash64("value") <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))))
        top = low.distinct().orderBy(F.xxhash64("value"), "value").limit(most)
        out[kind] = [r.value for r in top.collect()]
    return {k: v for k, v in out.items() if v}


def scan_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, base, found`` for each row: spans of the rules, and those that the automata add, with kind and value.

    The rules label credentials; from a bounded sample of them, and of other runs of the
    corpus, the automata are inferred. Then every candidate run of every text is scored.
    A null text is empty; rows come out as often as they go in; an empty table has an
    empty result. A text of any length is read once from start to end; equal values
    score equally. Other columns are not read.
    """
    rows = materialise(find_candidates(docs, text, id_col), "candidates")
    credentials, background = _sample(rows, "base", KINDS, SAMPLE_ROWS), _sample(rows, "runs", ("",), BACKGROUND_ROWS).get("", [])
    grammar = infer_grammar(credentials, background) if credentials else None
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = lru_cache(50_000)(shared.value.score_format) if shared.value else lambda _: (-1.0, "")  # formats are few
        for batch in batches:
            found = []
            for row in batch.column(2).to_pylist():
                scored = ((x, score(_symbols(x["value"]))) for x in row)
                found.append([x | {"kind": f"like_{kind}"} for x, (ratio, kind) in scored if ratio >= 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, batch.column(1).type)], names=["doc_id", "base", "found"])

    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(("doc_id", "base", "found"), rows.schema)]
    return rows.mapInArrow(run, ", ".join(kinds))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    joined = lambda spans: f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    both = "array_sort(concat(base, found), (x, y) -> CASE WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 ELSE cast(array_position(%s, x.kind) - array_position(%s, y.kind) AS int) END)"
    kinds = f"array({', '.join(repr(k) for k in (*KINDS, *(f'like_{k}' for k in KINDS)))})"  # those added come after the base kinds
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(joined("base")).cast("binary"), 256).alias("base_sha256"), F.expr(joined(both % (kinds, kinds))).alias("spans")
    )
