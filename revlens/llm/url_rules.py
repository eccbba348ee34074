"""URL rules as one bit-parallel automaton for wildcard patterns.

All globs are laid end to end as bits of a multiword state, one bit for each
prefix of each pattern.  A byte of the URL shifts the state by one and masks it
with the byte's word of masks (Shift-And); prefixes that a ``*`` follows keep
their bit.  One pass over a canonical URL so tells every glob that matches it.
The pass runs for a batch of URLs at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

STAR, ANY = object(), object()
BORDER = b"\xff"  # between host and path; no UTF-8 text has this byte

#: The rules by host and path, and hosts that are blocked where no rule decides.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BLOCKED_HOSTS = ("*casino*", "*free-bets*", "*ads-track*", "*-win.*", "ads.*", "*.ads.*")


def glob(text: str) -> list:
    """The parts of a glob: bytes, ``*`` (any run of bytes) and ``?`` (any byte); a backslash makes the next one plain."""
    parts, plain = [], False
    for b in text.encode():
        if b == 92 and not plain:
            plain = True
            continue
        parts.append(b if plain or b not in b"*?" else STAR if b == 42 else ANY)
        plain = False
    return parts


class ShiftAnd:
    """``matches(urls)`` has a row for each URL and a column for each pattern."""

    def __init__(self, patterns: list[list]):
        bits = sum(1 + sum(p is not STAR for p in pattern) for pattern in patterns)
        self.words = max(1, -(-bits // 64))
        self.mask = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.loop = np.zeros(self.words, dtype=np.uint64)
        self.final: list[tuple[int, int]] = []
        at = 0
        for pattern in patterns:
            self._set(self.start, at)
            for part in pattern:
                if part is STAR:
                    self._set(self.loop, at)
                    continue
                at += 1
                for b in range(256) if part is ANY else [part]:
                    self._set(self.mask[b], at)
            self.final.append(divmod(at, 64))
            at += 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        sizes = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(urls), dtype=np.uint8)
        first = (np.cumsum(sizes) - sizes)[order]
        state = np.tile(self.start, (len(urls), 1))
        live = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
        for t, n in enumerate(live.tolist()):  # the n longest still have a byte t
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.mask[flat[first[:n] + t]]
            moved |= now & self.loop
            state[:n] = moved
        out = np.zeros((len(urls), len(self.final)), dtype=bool)
        for i, (word, bit) in enumerate(self.final):
            out[order, i] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
        return out


@dataclass(frozen=True)
class Rules:
    """Rules (host, path, verdict) that fit a host and its subdomains below a path, and host globs for the rest."""

    rules: tuple[tuple[str, str, str], ...] = RULES
    blocked: tuple[str, ...] = BLOCKED_HOSTS

    def automaton(self) -> ShiftAnd:
        patterns = []
        for host, path, _ in self.rules:
            tail = [*host.encode(), *BORDER, *path.encode(), STAR]
            patterns += [tail, [STAR, ord("."), *tail]]
        return ShiftAnd(patterns + [[*glob(g), *BORDER, STAR] for g in self.blocked])

    def decide(self, automaton: ShiftAnd, urls: list[bytes]) -> tuple[list[str | None], list[str]]:
        """The longest rule that fits each URL (the first of equals), and its verdict or else that of the globs."""
        hit = automaton.matches(urls)
        n = len(self.rules)
        fits = hit[:, 0:2 * n:2] | hit[:, 1:2 * n:2]
        size = np.array([len(h + p) for h, p, _ in self.rules], dtype=np.int64)
        best = np.argmax(np.where(fits, size, -1), axis=1) if n else np.zeros(len(urls), dtype=np.int64)
        ruled = fits.any(axis=1)
        blocked = hit[:, 2 * n:].any(axis=1)
        rule = ["".join(self.rules[b][:2]) if r else None for b, r in zip(best.tolist(), ruled.tolist())]
        verdict = [self.rules[b][2] if r else "block" if x else "allow" for b, r, x in zip(best.tolist(), ruled.tolist(), blocked.tolist())]
        return rule, verdict


def _url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for null or without ``://``; only A-Z are lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules: Rules = Rules()) -> DataFrame:
    """(key, host, path, rule, verdict) for every row; null and malformed URLs have an empty host and path."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("__url"))
    host, path = _url_parts(F.col("__url"))
    rows = rows.select("key", host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = rules.automaton()
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            rule, verdict = rules.decide(automaton, [h.encode("utf-8", "surrogatepass") + BORDER + p.encode("utf-8", "surrogatepass") for h, p in pairs])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=["key", "host", "path", "rule", "verdict"])

    return arrow_map(rows, run, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


ORACLE_SQL = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
    SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
    FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT split.page_id, host, path, rule,
       coalesce(v, CASE WHEN host LIKE '%casino%' OR host LIKE '%free-bets%' OR host LIKE '%ads-track%' OR host LIKE '%-win.%'
                             OR host LIKE 'ads.%' OR host LIKE '%.ads.%' THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN fit ON fit.page_id = split.page_id
"""
