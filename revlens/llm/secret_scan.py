"""Secret scan with one combined deterministic automaton.

Every rule's regular expression is parsed into a nondeterministic automaton;
subset construction joins all of them, unanchored, into one deterministic
automaton, which is minimised and laid out as transition arrays.  One pass
over a text's UTF-8 bytes then tells which rules match anywhere in it.  Only
for those rules does a minimised automaton of the reversed rule walk back over
the text to mark where matches start, and an anchored one runs forward from
the leftmost start to the longest end.  No backtracking, no per-rule pass over
clean text.

Patterns are ASCII: literals, escapes, classes, groups, ``|``, ``* + ?`` and
``{m}``, ``{m,}``, ``{m,n}``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map


@dataclass(frozen=True)
class Rule:
    """``head``: a prefix pattern whose longest match is left out of the length that ``min_len`` asks for.

    Matches are leftmost and longest and don't overlap; one that is too short
    is dropped after it has taken its place.
    """

    kind: str
    pattern: str
    min_len: int = 1
    head: str = ""
    any_case: bool = False


#: The rules, in the order that ties between kinds follow.
_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _KEY + r"[A-Za-z0-9+/_.=-]+", 12, head=_KEY, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 40),
)
RULES = BASE_RULES + MORE_RULES


class _Parser:
    """Regular expression to a tree of ('set', bytes) | ('cat', ..) | ('alt', ..) | ('rep', x, low, high)."""

    def __init__(self, pattern: str, any_case: bool):
        self.s, self.i, self.any_case = pattern, 0, any_case

    def parse(self):
        tree = self.alt()
        if self.i < len(self.s):
            raise ValueError(f"unexpected {self.s[self.i]!r} at {self.i} in {self.s!r}")
        return tree

    def peek(self) -> str:
        return self.s[self.i:self.i + 1]

    def take(self) -> str:
        if self.i >= len(self.s):
            raise ValueError(f"{self.s!r} ends too early")
        self.i += 1
        return self.s[self.i - 1]

    def alt(self):
        parts = [self.cat()]
        while self.peek() == "|":
            self.take()
            parts.append(self.cat())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def cat(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat())
        return ("cat", parts)

    def repeat(self):
        node = self.atom()
        while self.peek() and self.peek() in "*+?{":
            c = self.take()
            if c == "{":
                end = self.s.index("}", self.i)
                low, comma, high = self.s[self.i:end].partition(",")
                self.i = end + 1
                low, high = int(low), (int(high) if high else None) if comma else int(low)
            else:
                low, high = {"*": (0, None), "+": (1, None), "?": (0, 1)}[c]
            node = ("rep", node, low, high)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alt()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.s!r}")
            return node
        if c == "[":
            chars: set[int] = set()
            while self.peek() != "]":
                low = high = self.char(self.take())
                if self.peek() == "-" and self.s[self.i + 1:self.i + 2] != "]":
                    self.take()
                    high = self.char(self.take())
                chars.update(range(low, high + 1))
            self.take()
            return self.cased(chars)
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        return self.cased({self.char(c)})

    def char(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                return int(self.take() + self.take(), 16)
            if c.isalnum():
                raise ValueError(f"escape \\{c} is not supported")
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def cased(self, chars: set[int]):
        if self.any_case:
            chars = {ord(f) for c in chars for f in (chr(c).lower(), chr(c).upper())}
        return ("set", frozenset(chars))


def _reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reverse(x) for x in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reverse(x) for x in tree[1]])
    if kind == "rep":
        return ("rep", _reverse(tree[1]), *tree[2:])
    return tree


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # transitions without a byte
        self.on: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Adds the tree from ``start``; gives its end state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.on[start].append((tree[1], end))
            return end
        if kind == "cat":
            for x in tree[1]:
                start = self.add(x, start)
            return start
        if kind == "alt":
            end = self.state()
            for x in tree[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(x, begin)].append(end)
            return end
        _, inner, low, high = tree
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(inner, loop)].append(loop)
            end = self.state()
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(high - low):
            start = self.add(inner, start)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``move[state, byte]`` is the next state; ``accept[state]`` has a bit for each tree that ends there."""

    move: np.ndarray
    accept: np.ndarray
    start: int


def build(trees: list, anchored: bool) -> Automaton:
    """Subset construction over byte classes, then minimisation by refining the partition of states."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for bit, tree in enumerate(trees):
        begin = nfa.state()
        nfa.free[root].append(begin)
        ends[nfa.add(tree, begin)] = bit
    if not anchored:
        nfa.on[root].append((frozenset(range(256)), root))
    sets = list({s for moves in nfa.on for s, _ in moves})
    shape = np.array([[b in s for s in sets] for b in range(256)], dtype=bool).reshape(256, len(sets))
    _, first, cls = np.unique(shape, axis=0, return_index=True, return_inverse=True)
    cls = cls.reshape(-1)
    ids = {nfa.closure([root]): 0}
    order, rows = list(ids), []
    for state in order:  # grows while it is read
        row = []
        for b in first.tolist():
            to = nfa.closure({t for q in state for s, t in nfa.on[q] if b in s})
            if to not in ids:
                ids[to] = len(ids)
                order.append(to)
            row.append(ids[to])
        rows.append(row)
    move = np.array(rows, dtype=np.int64)
    accept = np.array([sum(1 << ends[q] for q in state if q in ends) for state in order], dtype=np.int64)
    block = np.unique(accept, return_inverse=True)[1].reshape(-1)
    while True:
        _, keep, finer = np.unique(np.column_stack([block, block[move]]), axis=0, return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    _, keep = np.unique(block, return_index=True)
    return Automaton(block[move[keep]][:, cls].astype(np.int32), accept[keep], int(block[0]))


def _linked(auto: Automaton) -> list:
    """The transition arrays as rows that hold their successor rows; place 256 holds the accept bits, 257 whether it is dead."""
    dead = (auto.move == np.arange(len(auto.move))[:, None]).all(axis=1) & (auto.accept == 0)
    rows = [[None] * 258 for _ in range(len(auto.move))]
    for row, to, bits, end in zip(rows, auto.move.tolist(), auto.accept.tolist(), dead.tolist()):
        row[:256] = [rows[t] for t in to]
        row[256], row[257] = bits, end
    return rows[auto.start]


def _longest(row: list, data: bytes, start: int, stop: int) -> int:
    """The end of the longest match from ``start``; -1 if there is none."""
    end = start if row[256] else -1
    for i in range(start, stop):
        row = row[data[i]]
        if row[256]:
            end = i + 1
        elif row[257]:
            break
    return end


@dataclass(frozen=True)
class Compiled:
    """The combined automaton, and for each rule the reversed, the anchored and the head's."""

    rules: tuple[Rule, ...]
    combined: Automaton
    back: list[Automaton]
    forth: list[Automaton]
    head: list[Automaton | None]


@lru_cache(maxsize=4)
def compile_rules(rules: tuple[Rule, ...] = RULES) -> Compiled:
    trees = [_Parser(r.pattern, r.any_case).parse() for r in rules]
    heads = [build([_Parser(r.head, r.any_case).parse()], anchored=True) if r.head else None for r in rules]
    return Compiled(rules, build(trees, anchored=False), [build([_reverse(t)], anchored=False) for t in trees],
                    [build([t], anchored=True) for t in trees], heads)


class Scanner:
    """``spans(text)`` has (start, end, rule number) in code points, ordered by start, then rule."""

    def __init__(self, compiled: Compiled):
        self.rules = compiled.rules
        self._any = _linked(compiled.combined)
        self._back = [_linked(x) for x in compiled.back]
        self._from = [_linked(x) for x in compiled.forth]
        self._head = [x and _linked(x) for x in compiled.head]

    def matched(self, data: bytes) -> int:
        """Bits of the rules that match somewhere: one step for each byte."""
        row, found = self._any, 0
        for b in data:
            row = row[b]
            if row[256]:
                found |= row[256]
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        data = text.encode("utf-8", "surrogatepass")
        found = self.matched(data)
        out = []
        for n, rule in enumerate(self.rules):
            if not found >> n & 1:
                continue
            row, starts = self._back[n], []
            for i in range(len(data) - 1, -1, -1):
                row = row[data[i]]
                if row[256]:
                    starts.append(i)
            at = 0
            for s in reversed(starts):
                if s < at:
                    continue
                at = _longest(self._from[n], data, s, len(data))
                counted = s if self._head[n] is None else _longest(self._head[n], data, s, at)
                if at - counted >= rule.min_len:
                    out.append((s, at, n))
        if len(data) != len(text):
            out = [(len(data[:s].decode("utf-8", "surrogatepass")), len(data[:e].decode("utf-8", "surrogatepass")), n) for s, e, n in out]
        return sorted(out, key=lambda x: (x[0], x[2]))


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}  # of this worker process


def _scanner(shipped: Broadcast) -> Scanner:
    rules = shipped.value.rules
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(shipped.value)
    return _SCANNERS[rules]


SPAN_TYPE = "array<struct<start:int,end:int,kind:string>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def find_secrets(df: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, spans): every secret in every whole text, as code point ranges [start, end) with the rule's kind.

    A null text reads as '' and has no spans; a row comes out for each row in,
    null or repeated keys included.  Other columns are not read.
    """
    kind = df.schema[key].dataType
    shipped = df.sparkSession.sparkContext.broadcast(compile_rules(rules))  # a few MB, set by the rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(shipped)
        for batch in batches:
            found = [[{"start": s, "end": e, "kind": rules[n].kind} for s, e, n in scan.spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW_SPANS)], names=["key", "spans"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"key {kind.simpleString()}, spans {SPAN_TYPE}").withColumnRenamed("key", key)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def secret_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans and all spans as text."""
    found = find_secrets(df, key, text)
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.filter("spans", lambda s: s.kind.isin([r.kind for r in BASE_RULES]))
    return found.select(
        key, of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with each secret in ``text`` replaced by ``[kind]``; overlapping spans become one, named by the first.

    Clean and null texts stay as they are; all rows and columns are kept.
    """
    shipped = df.sparkSession.sparkContext.broadcast(compile_rules(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(shipped)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            for i, t in enumerate(texts):
                spans = scan.spans(t) if t else []
                if spans:
                    out, done = [], 0
                    for s, e, n in spans:
                        if s >= done:
                            out += [t[done:s], f"[{rules[n].kind}]"]
                        done = max(done, e)
                    texts[i] = "".join([*out, t[done:]])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return arrow_map(df, run, df.schema)


def span_digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of ``secret_report`` for spans given in order."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
