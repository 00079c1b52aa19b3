"""Secret scans by one combined deterministic automaton.

Rule patterns become small instruction lists; ordered subset construction gives, for
each rule, an automaton that searches leftmost and greedily; their product is minimised
into one transition array over bytes. All rules are scanned in one pass over the bytes
of a batch: the batch is cut after bytes that bring every state to the same one, and
the pieces advance together.

Nulls and empty texts have no spans; repeated rows are scanned as they stand; a column
named like the output is replaced; any other column is passed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as C
from re import _parser as P

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, put_columns, utf8, with_fields

END = 0xFF  # never occurs in UTF-8; ends every text


@dataclass(frozen=True)
class Rule:
    """pattern: what the automaton finds; a find counts if `tail` characters of its last group, and `least` in all, are there."""

    kind: str
    pattern: str
    least: int = 0
    tail: int = 0


#: The base kinds, in their order.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", tail=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public token formats found in addition.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def program(pattern: str, reverse: bool = False) -> list[tuple]:
    """('set', bytes) | ('split', first, second) | ('match',); of the pattern's mirror image if reverse."""
    code: list[tuple] = []

    def both_cases(chars: set[int], fold: bool) -> frozenset[int]:
        if fold:
            chars = chars | {ord(chr(c).swapcase()) for c in chars if c < 128}
        return frozenset(chars)

    def emit(items, fold: bool) -> None:
        for op, av in reversed(list(items)) if reverse else items:
            if op is C.LITERAL:
                code.append(("set", both_cases({av}, fold)))
            elif op is C.IN:
                chars: set[int] = set()
                for kind, x in av:
                    chars |= {x} if kind is C.LITERAL else set(range(x[0], x[1] + 1))
                code.append(("set", both_cases(chars, fold)))
            elif op is C.SUBPATTERN:
                emit(av[3], fold or bool(av[1] & re.IGNORECASE))
            elif op is C.BRANCH:
                jumps = []
                for branch in av[1][:-1]:
                    code.append(("split", len(code) + 1, None))
                    at = len(code) - 1
                    emit(branch, fold)
                    code.append(("split", None, None))
                    jumps.append(len(code) - 1)
                    code[at] = ("split", at + 1, len(code))
                emit(av[1][-1], fold)
                for j in jumps:
                    code[j] = ("split", len(code), len(code))
            elif op is C.MAX_REPEAT:
                low, high, body = av
                for _ in range(low):
                    emit(body, fold)
                if high is C.MAXREPEAT:
                    at = len(code)
                    code.append(("split", None, None))
                    emit(body, fold)
                    code.append(("split", at, at))
                    code[at] = ("split", at + 1, len(code))
                else:
                    for _ in range(high - low):
                        at = len(code)
                        code.append(("split", None, None))
                        emit(body, fold)
                        code[at] = ("split", at + 1, len(code))
            else:
                raise ValueError(f"not supported in a rule: {op}")

    emit(P.parse(pattern), False)
    return [*code, ("match",)]


def closure(code: list[tuple], pc: int, into: list[int], seen: set[int]) -> bool:
    """Add what pc leads to, by priority, to `into`; True once a match is reached."""
    if pc in seen:
        return False
    seen.add(pc)
    if code[pc][0] == "match":
        return True
    if code[pc][0] == "set":
        into.append(pc)
        return False
    return closure(code, code[pc][1], into, seen) or closure(code, code[pc][2], into, seen)


class Search:
    """One rule's searching automaton: a state is (threads by priority, whether a match ends here)."""

    def __init__(self, pattern: str):
        self.code = program(pattern)
        threads: list[int] = []
        if closure(self.code, 0, threads, set()):
            raise ValueError(f"matches the empty string: {pattern}")
        self.start = (tuple(threads), False)

    def step(self, state: tuple, byte: int) -> tuple[tuple, bool]:
        """Next state, and whether a match ended before this byte."""
        threads, matched = state
        new: list[int] = []
        seen: set[int] = set()
        for pc in threads:
            if byte in self.code[pc][1] and closure(self.code, pc + 1, new, seen):
                return (tuple(new), True), False
        if matched:
            if new:
                raise ValueError("a rule's match may only be extended by longer matches")
            return self.step(self.start, byte)[0], True
        closure(self.code, 0, new, seen)
        return (tuple(new), False), False


@dataclass(frozen=True)
class Automaton:
    """step[s * 256 + byte] is 256 times the next state, ended[...] the rules (bits) whose match ended before the byte; state 0 starts."""

    rules: tuple[Rule, ...]
    step: np.ndarray
    ended: np.ndarray
    reset: np.ndarray  # bytes after which the state is known
    after: np.ndarray  # that state times 256
    backward: tuple


@lru_cache(maxsize=8)
def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    """Subset construction over byte classes, then minimisation by refinement."""
    searches = [Search(r.pattern) for r in rules]
    sets = [x[1] for s in searches for x in s.code if x[0] == "set"]
    by_sets: dict[tuple, int] = {}
    class_of = np.array([by_sets.setdefault(tuple(b in s for s in sets), len(by_sets)) for b in range(256)])
    sample = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(by_sets))]
    start = tuple(s.start for s in searches)
    number, todo = {start: 0}, [start]
    steps: list[list[int]] = []
    ends: list[list[int]] = []
    memo: dict[tuple, tuple] = {}
    for state in todo:
        row, out = [], []
        for byte in sample:
            parts, bits = [], 0
            for i, (search, s) in enumerate(zip(searches, state, strict=True)):
                if (i, s, byte) not in memo:
                    memo[i, s, byte] = search.step(s, byte)
                s, e = memo[i, s, byte]
                parts.append(s)
                bits |= e << i
            key = tuple(parts)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            row.append(number[key])
            out.append(bits)
        steps.append(row)
        ends.append(out)
    step, ended = np.array(steps), np.array(ends)
    _, group = np.unique(ended, axis=0, return_inverse=True)
    group = group.ravel()
    while True:
        _, finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    order = np.full(group.max() + 1, len(group))
    np.minimum.at(order, group, np.arange(len(group)))
    rank = np.argsort(np.argsort(order))
    first = np.sort(order)  # of each group the state met first; the start stays 0
    step, ended = rank[group[step[first]]][:, class_of], ended[first][:, class_of]
    known = (step == step[0]).all(axis=0)
    return Automaton(rules, (step * 256).astype(np.int32).ravel(), ended.astype(np.uint16).ravel(), known, (step[0] * 256).astype(np.int32), tuple(tuple(program(r.pattern, True)) for r in rules))


def reached(code: tuple, starts: list[int]) -> tuple[frozenset[int], bool]:
    """All sets that follow from the starts, and whether a match does."""
    stack, done = list(starts), set()
    while stack:
        pc = stack.pop()
        if pc not in done:
            done.add(pc)
            stack += code[pc][1:] if code[pc][0] == "split" else ()
    return frozenset(pc for pc in done if code[pc][0] == "set"), len(code) - 1 in done


def first_of(code: tuple, text: bytes, end: int, floor: int, memo: dict) -> int:
    """Leftmost start, not before floor, of a match that ends at `end`, by the mirrored rule's automaton (built as it is used)."""
    if not memo:
        memo[None] = reached(code, [0])[0]
    state, best, at = memo[None], end, end
    while at > floor and state:
        at -= 1
        key = (state, text[at])
        if key not in memo:
            memo[key] = reached(code, [pc + 1 for pc in state if text[at] in code[pc][1]])
        state, hit = memo[key]
        if hit:
            best = at
    return best


def ends_in(a: Automaton, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions before which matches end and the rules they are of; data ends with END."""
    resets = np.flatnonzero(a.reset[data])
    stride = max(256, len(data) // 4096)
    cuts = np.unique(resets[np.searchsorted(resets, np.arange(stride, len(data), stride))] + 1) if len(data) > stride else np.zeros(0, np.int64)
    cuts = cuts[cuts < len(data)]
    begin = np.concatenate([[0], cuts])
    length = np.diff(np.concatenate([begin, [len(data)]]))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    state = np.where(begin > 0, a.after[data[np.maximum(begin - 1, 0)]], 0).astype(np.int32)
    live = np.searchsorted(-length, -np.arange(length[0]), "left")  # pieces longer than t
    where, what = [], []
    few = 4
    t = 0
    while t < length[0] and live[t] > few:
        at = begin[: live[t]] + t
        i = state[: live[t]] + data[at]
        e = a.ended[i]
        if e.any():
            hit = np.flatnonzero(e)
            where.append(at[hit])
            what.append(e[hit])
        state[: live[t]] = a.step[i]
        t += 1
    if t < length[0]:
        step, ended = memoryview(a.step), memoryview(a.ended)
        for k in range(int(live[t])):
            s, base = int(state[k]), int(begin[k])
            found = []
            for at, byte in enumerate(data[base + t : base + int(length[k])].tobytes(), base + t):
                i = s + byte
                if ended[i]:
                    found.append((at, ended[i]))
                s = step[i]
            if found:
                where.append(np.array([x for x, _ in found]))
                what.append(np.array([x for _, x in found], np.uint16))
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.uint16)
    where, what = np.concatenate(where), np.concatenate(what)
    order = np.argsort(where)
    return where[order], what[order]


def spans_in(a: Automaton, data: np.ndarray, offsets: np.ndarray, memos: list[dict]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Of each row that has any: (start, rule, end) in code points, sorted."""
    n = len(offsets) - 1
    shifted = offsets + np.arange(n + 1)
    joined = np.full(len(data) + n, END, np.uint8)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    joined[np.arange(len(data)) + rows] = data
    where, what = ends_in(a, joined)
    rows = np.searchsorted(shifted, where, "right") - 1
    checks = [re.compile(r.pattern.encode()) for r in a.rules]
    for row in np.unique(rows).tolist():
        text = data[offsets[row] : offsets[row + 1]].tobytes()
        at = slice(*np.searchsorted(rows, [row, row + 1]))
        floor, found = [0] * len(a.rules), []
        for end, bits in zip((where[at] - shifted[row]).tolist(), what[at].tolist(), strict=True):
            for i, rule in enumerate(a.rules):
                if bits >> i & 1:
                    start = first_of(a.backward[i], text, end, floor[i], memos[i])
                    floor[i] = end
                    if end - start < rule.least or (rule.tail and len((m := checks[i].fullmatch(text, start, end)) and m[m.re.groups] or b"") < rule.tail):
                        continue
                    found.append((start, i, end))
        if found:
            places = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
            code = lambda p: int(places[p - 1]) if p else 0  # noqa: B023, E731
            yield row, sorted((code(s), i, code(e)) for s, i, e in found)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def redact(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    """text with each span (overlapping ones as one) replaced by its first kind in brackets."""
    out, at = [], 0
    for start, i, end in spans:
        if start >= at:
            out += [text[at:start], f"[{rules[i].kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", rules: tuple[Rule, ...] = RULES, redacted: str | None = None) -> DataFrame:
    """docs with column `out`: the spans found in each whole text, by start, then rule.

    redacted: also put the text with its secrets replaced by their kinds into this
    column (it may be `text` itself); null stays null.
    """
    automaton = compile_rules(rules)
    kinds = [r.kind for r in rules]
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    fields = [T.StructField(out, SPANS)] + ([T.StructField(redacted, T.StringType())] if redacted else [])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos: list[dict] = [{} for _ in rules]
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            data, offsets = utf8(column)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for a, b in pieces(offsets, 8_000_000):
                for row, found in spans_in(automaton, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], memos):
                    spans[a + row] = found
            new = {out: pa.array([[{"kind": kinds[i], "start": s, "end": e} for s, i, e in x] for x in spans], span_type)}
            if redacted:
                hit = {i: redact(column[i].as_py(), x, rules) for i, x in enumerate(spans) if x}
                new[redacted] = pa.array([hit.get(i, v) for i, v in enumerate(column.to_pylist())], pa.string())
            yield put_columns(batch, new)

    return docs.mapInArrow(scan, with_fields(docs.schema, *fields))


def spans_text(spans, kinds: list[str] | None = None):
    """kind:start:end, comma-joined, of the spans of the given kinds (all if none are given)."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op5_secrets(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs.select("doc_id", "text"))
    base = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id",
        *[F.size(F.filter("secrets", of_kind(k))).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(spans_text(F.col("secrets"), base), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )
