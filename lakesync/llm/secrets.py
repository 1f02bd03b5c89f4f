"""Secret scans: the regexes of all rules as one minimised deterministic automaton.

The rules' regexes become one nondeterministic automaton, subset construction makes it
deterministic and partition refinement makes it small; the result is an array from (state,
byte class) to state. One pass over the bytes of a text then tells where a match of any rule
ends. A task cuts its texts into stretches of `STRETCH` bytes, which advance together, a byte
a step; a stretch whose first state turns out otherwise than assumed is run again until its
states agree, so the states are those of a single pass. Where a match ends, a second automaton
for the reversed rule runs back to its first byte.

Matches of a rule are leftmost and do not overlap. A short check on the matched text follows
(lengths). Positions count code points, ends are exclusive.

Rows: a null or empty text has no spans. Repeated rows are scanned each; other columns pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from re import _constants as kinds
from re import _parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import other_columns, schema_of, sent, text_slices

STRETCH = 256
# Replaces a span in a cleaned text.
PLACEHOLDER = "<secret>"


class Rule(NamedTuple):
    kind: str
    regex: str
    # Whether a match counts, and what of it counts: a regex for the whole match with a shortest length of its last group.
    least: int = 0


def either_case(text: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in text)


KEYWORD = "|".join(either_case(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
# The three base rules in their listed order, then public formats of credentials.
RULES = (
    Rule("assign", rf"({KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12),
    Rule("access", r"(AKIA[A-Z0-9]+)", 18),
    # A run of 16 or more is a run of one or more that is long enough.
    Rule("hex", r"([0-9a-f]{16,})", 16),
    Rule("hosting", r"(gh[pousr]_[A-Za-z0-9]+)", 40),
    Rule("chat", r"(xox[abprs]-[A-Za-z0-9-]+)", 20),
    Rule("cloud", r"(AIza[A-Za-z0-9_-]+)", 39),
    Rule("payment", r"([rs]k_live_[A-Za-z0-9]+)", 24),
    Rule("key", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)"),
)
BASE_KINDS = ("assign", "access", "hex")


class Automaton(NamedTuple):
    """States are numbers times the count of classes; state 0 is the first, `dead` the one without a way out or -1."""

    # Of each byte; the next state at [state + class]; bits of the rules that end, at [state // classes].
    classes: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    dead: int


class Nfa:
    """States with moves on byte sets and empty moves; built from the syntax trees of Python's regex parser."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def build(self, items, start: int, backwards: bool) -> int:
        """Add a sequence of syntax items from a state; the state after it."""
        at = start
        for kind, value in reversed(list(items)) if backwards else items:
            at = self.add(kind, value, at, backwards)
        return at

    def add(self, kind, value, at: int, backwards: bool) -> int:
        if kind in (kinds.LITERAL, kinds.NOT_LITERAL, kinds.IN):
            end = self.state()
            self.moves[at].append((byte_set(kind, value), end))
            return end
        if kind is kinds.SUBPATTERN:
            return self.build(value[-1], at, backwards)
        if kind is kinds.BRANCH:
            end = self.state()
            for option in value[1]:
                first = self.state()
                self.empty[at].append(first)
                self.empty[self.build(option, first, backwards)].append(end)
            return end
        if kind is kinds.MAX_REPEAT:
            low, high, item = value
            for _ in range(low):
                at = self.build(item, at, backwards)
            if high is kinds.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[at].append(loop)
                self.empty[loop].append(end)
                self.empty[self.build(item, loop, backwards)].append(loop)
                return end
            end = self.state()
            for _ in range(high - low):
                self.empty[at].append(end)
                at = self.build(item, at, backwards)
            self.empty[at].append(end)
            return end
        raise ValueError(f"a rule may not use {kind}")

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


def byte_set(kind, value) -> frozenset[int]:
    if kind is kinds.LITERAL:
        return frozenset([value])
    if kind is kinds.NOT_LITERAL:
        return frozenset(set(range(256)) - {value})
    out: set[int] = set()
    negated = False
    for part, x in value:
        if part is kinds.NEGATE:
            negated = True
        elif part is kinds.LITERAL:
            out.add(x)
        elif part is kinds.RANGE:
            out |= set(range(x[0], x[1] + 1))
        elif part is kinds.CATEGORY and x is kinds.CATEGORY_SPACE:
            out |= {0x20, *range(0x09, 0x0E)}
        else:
            raise ValueError(f"a rule may not use {part}")
    return frozenset(set(range(256)) - out if negated else out)


def compiled(rules: list[str], anywhere: bool, backwards: bool = False) -> Automaton:
    """One automaton for all regexes: beginning at any byte, or at the first only."""
    nfa = Nfa()
    start = nfa.state()
    finals = {}
    for bit, rule in enumerate(rules):
        first = nfa.state()
        nfa.empty[start].append(first)
        finals[nfa.build(parser.parse(rule.encode()), first, backwards)] = 1 << bit
    # Bytes that no set tells apart are one class.
    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    signatures = [tuple(b in s for s in sets) for b in range(256)]
    numbers = {x: i for i, x in enumerate(dict.fromkeys(signatures))}
    classes = np.array([numbers[x] for x in signatures], np.uint8)
    sample = [signatures.index(x) for x in numbers]
    # Sets of states are bits of an integer; leads[class][state] is the set that one move leads to.
    closed = [bits(nfa.closed([x])) for x in range(len(nfa.moves))]
    leads = [[0] * len(nfa.moves) for _ in sample]
    for number, byte in enumerate(sample):
        for x, moves in enumerate(nfa.moves):
            for s, end in moves:
                if byte in s:
                    leads[number][x] |= closed[end]
    begin = closed[start]
    always = begin if anywhere else 0
    known, todo, rows = {begin: 0}, [begin], []
    for now in todo:
        members = [x for x in range(now.bit_length()) if now >> x & 1]
        row = []
        for lead in leads:
            to = always
            for x in members:
                to |= lead[x]
            if to not in known:
                known[to] = len(known)
                todo.append(to)
            row.append(known[to])
        rows.append(row)
    accepts = np.array([sum(bit for x, bit in finals.items() if now >> x & 1) for now in known], np.int64)
    return minimised(classes, np.array(rows, np.int64), accepts)


def bits(states: frozenset[int]) -> int:
    return sum(1 << x for x in states)


def minimised(classes: np.ndarray, step: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Split blocks of states until all of a block accept the same and lead to the same blocks."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    # The first state's block becomes 0.
    order = np.unique(block, return_index=True)[1]
    rank = np.argsort(np.argsort(np.where(np.arange(len(order)) == block[0], -1, order)))
    kept = np.empty(len(order), np.int64)
    kept[rank] = order
    moved = rank[block[step[kept]]]
    width = step.shape[1]
    stuck = np.flatnonzero((moved == np.arange(len(kept))[:, None]).all(axis=1) & (accepts[kept] == 0))
    return Automaton(classes, (moved * width).astype(np.int32).ravel(), accepts[kept], int(stuck[0]) * width if len(stuck) else -1)


def states(data: np.ndarray, automaton: Automaton) -> np.ndarray:
    """The state (times the number of classes) after every byte of data, whose length is a multiple of STRETCH."""
    classes = np.ascontiguousarray(automaton.classes[data].reshape(-1, STRETCH).T).astype(np.int32)
    step = automaton.step
    out = np.empty(classes.shape, np.int32)
    state = np.zeros(classes.shape[1], np.int32)
    for i in range(STRETCH):
        state = step[state + classes[i]]
        out[i] = state
    begins = np.zeros(classes.shape[1], np.int32)
    while True:
        actual = np.concatenate([[0], out[-1, :-1]]).astype(np.int32)
        lanes = np.flatnonzero(actual != begins)
        if not len(lanes):
            return out.T.ravel()
        begins[lanes] = actual[lanes]
        state = actual[lanes]
        for i in range(STRETCH):
            state = step[state + classes[i, lanes]]
            differs = state != out[i, lanes]
            # From the first equal state on, the rest is as before.
            lanes, state = lanes[differs], state[differs]
            if not len(lanes):
                break
            out[i, lanes] = state


class Scanner(NamedTuple):
    rules: tuple[Rule, ...]
    forward: Automaton
    back: tuple[Automaton, ...]


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    forward = compiled([r.regex for r in rules], anywhere=True)
    width = int(forward.classes.max()) + 1
    if (forward.step.reshape(-1, width)[:, forward.classes[10]] != 0).any():
        raise ValueError("no rule may match across lines")
    return Scanner(rules, forward, tuple(compiled([r.regex], False, True) for r in rules))


def found(data: np.ndarray, offsets: np.ndarray, scan: Scanner) -> dict[int, list[tuple[int, int, int]]]:
    """(start, end, rule) in bytes of each row of a slice that has matches."""
    automaton = scan.forward
    count = len(offsets) - 1
    # A line feed after each text brings the automaton back to its first state.
    size = len(data) + count
    joined = np.full(-(-max(size, 1) // STRETCH) * STRETCH, 10, np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(count), np.diff(offsets))] = data
    width = int(automaton.classes.max()) + 1
    accepted = automaton.accepts[states(joined, automaton) // width]
    places = np.flatnonzero(accepted)
    begins = offsets + np.arange(count + 1)
    rows = np.searchsorted(begins, places, "right") - 1
    out: dict[int, list[tuple[int, int, int]]] = {}
    for rule in range(len(scan.rules)):
        bit = (accepted[places] >> rule) & 1 == 1
        at, row = places[bit], rows[bit]
        last = np.ones(len(at), bool)
        last[:-1] = at[1:] != at[:-1] + 1
        free: dict[int, int] = {}
        for end, r in zip((at[last] + 1).tolist(), row[last].tolist(), strict=True):
            begin = int(begins[r])
            start = first_byte(joined, end, free.get(r, begin), scan.back[rule])
            if start < end:
                free[r] = end
                if counts(scan.rules[rule], joined[start:end].tobytes()):
                    out.setdefault(r, []).append((start - begin, end - begin, rule))
    for spans in out.values():
        spans.sort(key=lambda x: (x[0], x[2]))
    return out


def first_byte(data: np.ndarray, end: int, low: int, automaton: Automaton) -> int:
    """Where the longest match that ends at `end` begins, not before `low`; `end` if there is none."""
    width = int(automaton.classes.max()) + 1
    step, accepts, classes = automaton.step, automaton.accepts, automaton.classes
    state, start = 0, end
    for i in range(end - 1, low - 1, -1):
        state = step[state + classes[data[i]]]
        if accepts[state // width]:
            start = i
        elif state == automaton.dead:
            break
    return start


def counts(rule: Rule, matched: bytes) -> bool:
    """The exact check of a match: its last group is long enough."""
    hit = re.fullmatch(rule.regex.encode(), matched)
    return hit is not None and len(hit[hit.re.groups]) >= rule.least


def written_spans(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...], base: bool) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, b, k in spans if not base or rules[k].kind in BASE_KINDS)


def cleaned(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], PLACEHOLDER]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, output: Callable | None = None) -> DataFrame:
    """docs, without text, with n_assign, n_access, n_hex, base_sha256, spans and cleaned, the text without secrets."""
    shared = sent(docs.sparkSession, scanner(rules))
    types = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string", "cleaned": "string"}
    rest = other_columns(docs, ["text", *types])
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        scan = shared.value
        for batch in batches:
            texts = batch.column("text")
            columns = {"n_assign": [0] * len(texts), "n_access": [0] * len(texts), "n_hex": [0] * len(texts)}
            columns |= {"base_sha256": [nothing] * len(texts), "spans": [""] * len(texts)}
            changed = {}
            for low, _, data, offsets in text_slices(texts):
                for row, spans in found(data, offsets, scan).items():
                    raw = data[offsets[row] : offsets[row + 1]]
                    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    spans = [(int(points[a]), int(points[b]), k) for a, b, k in spans]
                    for kind in BASE_KINDS:
                        columns[f"n_{kind}"][low + row] = sum(scan.rules[k].kind == kind for _, _, k in spans)
                    columns["base_sha256"][low + row] = hashlib.sha256(written_spans(spans, scan.rules, True).encode()).hexdigest()
                    columns["spans"][low + row] = written_spans(spans, scan.rules, False)
                    changed[low + row] = cleaned(raw.tobytes().decode(), spans)
            if changed:
                mask = np.zeros(len(texts), bool)
                mask[list(changed)] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array([changed[i] for i in sorted(changed)], texts.type))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(x) for x in columns.values()), texts.cast(pa.string())],
                names=[*rest, *types],
            )

    wanted = docs.select(*rest, F.col("text").cast("string").alias("text"))
    schema = schema_of(docs, rest)
    for name, kind in types.items():
        schema.add(name, kind)
    return wanted.mapInArrow(run, schema)


def document_secrets(docs: DataFrame) -> DataFrame:
    """The spans of every document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return scanned(docs.select("doc_id", "text")).drop("cleaned")
