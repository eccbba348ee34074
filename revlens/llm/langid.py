"""Language identification in two steps: the family first, then the language within it.

Each step votes with one-versus-one linear support vector machines.  Their
features are relative frequencies of hashed byte trigrams of the lower-cased
text, with everything but letters as a space; a linear machine's score is then
the mean weight of a text's trigrams, so prediction is one lookup and sum for
each byte and machine.  A step with more than ``WIDEST`` classes votes between
groups of alike classes first, then within the winning group, so that machines
grow in proportion to the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stash, text_slices

#: The family of each language code; any other is a family of its own.
FAMILIES = {
    "af": "germanic", "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic",
    "no": "germanic", "sv": "germanic", "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "uk": "slavic",
}
UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 500  # bound of the labelled rows that are fitted on, for each language
SAMPLE_ROWS = 20_000  # and for all languages together, but for one row of each
WIDEST = 16  # classes that one vote decides between
BUCKETS = 1 << 11

_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[:] = 32
_LETTER[128:] = np.arange(128, 256)
for _c in b"abcdefghijklmnopqrstuvwxyz":
    _LETTER[_c] = _c


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram, start): the trigrams of all texts one after another, and where each text's begin."""
    data = [b" " + t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    raw = _LETTER[np.frombuffer(b"".join(data), dtype=np.uint8)].astype(np.uint32)
    ends = np.cumsum([len(d) for d in data])
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    code = raw[:-2] * np.uint32(0x10001) + raw[1:-1] * np.uint32(0x101) + raw[2:]
    blank = (raw[1:-1] == 32) & ((raw[:-2] == 32) | (raw[2:] == 32))
    keep = ~blank
    edge = np.concatenate([ends - 2, ends - 1])
    keep[edge[(edge >= 0) & (edge < len(keep))]] = False
    total = np.concatenate([[0], np.cumsum(keep)])
    starts = total[np.minimum(np.concatenate([[0], ends]), len(keep))]
    hashed = (code[keep] * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(BUCKETS).bit_length() + 1)
    return hashed.astype(np.int64), starts


@dataclass(frozen=True)
class Step:
    """One vote: its outcomes are languages, or further steps; a weight vector, with its bias, for each pair of them."""

    outcomes: list[str | Step]
    machines: list[tuple[int, int, np.ndarray, float]]

    def vote(self, grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outcome, how sure from 0 to 1) of each text; ties go to the first outcome.

        Each text's weights are added by themselves, so that a score doesn't
        depend on which texts come with it.
        """
        count = np.diff(starts)
        votes = np.zeros((len(count), len(self.outcomes)))
        filled = np.flatnonzero(count)
        for a, b, w, bias in self.machines:
            margin = np.full(len(count), bias)
            if len(filled):
                margin[filled] += np.add.reduceat(w[grams], starts[filled]) / count[filled]
            chance = 1 / (1 + np.exp(-np.clip(4 * margin, -30, 30)))
            votes[:, a] += chance
            votes[:, b] += 1 - chance
        best = np.argmax(votes, axis=1)
        sure = votes[np.arange(len(count)), best] / max(1, len(self.outcomes) - 1) if self.machines else np.ones(len(count))
        return best, sure


@dataclass(frozen=True)
class Model:
    """``first``: the vote between families, whose outcomes are the votes within them; None if nothing was learned."""

    first: Step | None

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score from 0 to 1; ``und`` and 0 without a letter."""
        lang = np.full(len(texts), UNKNOWN, dtype=object)
        score = np.zeros(len(texts))
        seen = [i for i, t in enumerate(texts) if any(map(str.isalpha, t[:64])) or any(map(str.isalpha, t))]
        todo = [(self.first, np.array(seen, dtype=np.int64), np.ones(len(seen)))] if self.first and seen else []
        grams, starts = trigrams(texts) if todo else (None, None)
        while todo:
            step, rows, before = todo.pop()
            best, sure = step.vote(*_of_rows(grams, starts, rows))
            for k in np.unique(best).tolist():
                mine, so_far = rows[best == k], (before * sure)[best == k]
                if isinstance(step.outcomes[k], Step):
                    todo.append((step.outcomes[k], mine, so_far))
                else:
                    lang[mine], score[mine] = step.outcomes[k], so_far
        return lang.tolist(), score


def _of_rows(grams: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of the texts ``rows`` alone, and where each one's begin."""
    if len(rows) == len(starts) - 1:
        return grams, starts
    count = starts[rows + 1] - starts[rows]
    at = np.concatenate([[0], np.cumsum(count)])
    return grams[np.repeat(starts[rows] - at[:-1], count) + np.arange(at[-1])], at


def fit(labels: list[str], features: np.ndarray) -> Model:
    """One-versus-one machines for the families and for the languages of each; ``features``: relative frequencies."""
    families: dict[str, list[str]] = {}
    for lang in sorted(set(labels)):
        families.setdefault(FAMILIES.get(lang, lang), []).append(lang)
    lang = np.array(labels, dtype=object)
    return Model(_step([_step(families[f], lang, features) for f in sorted(families)], lang, features)) if families else Model(None)


def _languages(outcome: str | Step) -> list[str]:
    return [outcome] if isinstance(outcome, str) else [x for o in outcome.outcomes for x in _languages(o)]


def _step(outcomes: list[str | Step], y: np.ndarray, x: np.ndarray) -> Step:
    """A vote between ``outcomes``; more than ``WIDEST`` are put in order along the axis on which they differ most, and grouped."""
    part = {name: i for i, o in enumerate(outcomes) for name in _languages(o)}
    number = np.array([part.get(name, -1) for name in y])
    if len(outcomes) > WIDEST:
        means = np.array([x[number == i].mean(axis=0, dtype=np.float64) for i in range(len(outcomes))])
        means -= means.mean(axis=0)
        axis = np.linalg.eigh(means @ means.T)[1][:, -1]
        groups = np.array_split(np.argsort(axis, kind="stable"), min(WIDEST, -(-len(outcomes) // WIDEST)))
        return _step([_step([outcomes[i] for i in g], y, x) for g in groups], y, x)
    return Step(outcomes, _pairs(len(outcomes), number, x))


def _pairs(classes: int, y: np.ndarray, x: np.ndarray) -> list[tuple[int, int, np.ndarray, float]]:
    out = []
    for a in range(classes):
        for b in range(a + 1, classes):
            mine = (y == a) | (y == b)
            w, bias = linear_svm(x[mine], np.where(y[mine] == a, 1.0, -1.0))
            out.append((a, b, w, bias))
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, classes weighted alike, by conjugate Newton steps on the active rows."""
    scale = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x) + 1e-8)
    z = np.ones((len(x), x.shape[1] + 1), dtype=np.float32)
    np.divide(x, scale * np.sqrt(x.shape[1]), out=z[:, :-1], casting="same_kind")
    weight = np.where(y > 0, 0.5 / max(1, np.sum(y > 0)), 0.5 / max(1, np.sum(y < 0))) * c * len(y) / 10
    v = np.zeros(z.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (z @ v)
        on = slack > 0
        gradient = v - 2 * z[on].T @ (weight[on] * y[on] * slack[on])
        if np.abs(gradient).max() < 1e-5:
            break
        zo, wo = z[on], 2 * weight[on]
        step, r = np.zeros_like(v), -gradient
        p, rr = r.copy(), r @ r
        for _ in range(30):
            hp = p + zo.T @ (wo * (zo @ p))
            alpha = rr / (p @ hp)
            step += alpha * p
            r -= alpha * hp
            new = r @ r
            if new < 1e-12 * (gradient @ gradient):
                break
            p, rr = r + (new / rr) * p, new
        v = v + step
    return v[:-1] / scale / np.sqrt(x.shape[1]), float(v[-1])


def held_out(key: str) -> Column:
    """Rows that are never learned from: a third, by a checksum of the key (false for a null key)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def learning_rows(df: DataFrame, key: str, text: str, lang: str, per_language: int = SAMPLE_PER_LANGUAGE,
                  most_rows: int = SAMPLE_ROWS) -> DataFrame | None:
    """(lang, text): the rows to fit on, or None if no row can teach.

    At most about ``per_language`` of each language and ``most_rows`` in all,
    and at least one of each language, from rows with text and label that
    aren't held out.  Which ones is set by a hash of key and text, so it is the
    same at any layout, and neither a null key nor copies held by very many
    rows lift the bound.
    """
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).cast("string").alias("key"), held_out(key).alias("out"))
    rows = rows.where(~F.col("out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.xxhash64("key", "text", F.lit("learn")).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    rows = rows.select("lang", "text", draw.alias("draw"))
    found = stash(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")), "languages")
    classes = found.count()
    if not classes:
        return None
    share = F.greatest(F.lit(min(per_language, most_rows / classes)) / F.col("n"), F.col("least"))
    picked = rows.join(found.select("lang", share.alias("share")), "lang").where(F.col("draw") <= F.col("share"))
    return picked.select("lang", "text").distinct()


def train(df: DataFrame, key: str, text: str, lang: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fits on the bounded sample of ``learning_rows``; without any such row, nothing is learned."""
    picked = learning_rows(df, key, text, lang, per_language)
    if picked is None:
        return Model(None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(1).to_pylist()):
                grams, starts = trigrams(part)
                count = np.diff(starts)
                doc = np.repeat(np.arange(len(part)), count)
                x = np.bincount(doc * BUCKETS + grams, minlength=len(part) * BUCKETS).reshape(len(part), BUCKETS)
                x = (x / np.maximum(count, 1)[:, None]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=["lang", "x"])

    got = sorted(((r[0], bytes(r[1])) for r in arrow_map(picked, run, "lang string, x binary").collect()))
    x = np.array([np.frombuffer(b, np.float16) for _, b in got], dtype=np.float32).reshape(len(got), BUCKETS)
    used = x.any(axis=1)
    return fit([g[0] for g, u in zip(got, used) if u], x[used]) if used.any() else Model(None)


def identify(df: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """(key, lang_pred, score) of every whole text; null texts and those without a letter are ``und`` with score 0."""
    kind = df.schema[key].dataType.simpleString()
    shipped = df.sparkSession.sparkContext.broadcast(model)  # classes times buckets, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(1).to_pylist()):
                lang, score = shipped.value.predict(part)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["key", "lang_pred", "score"])

    return arrow_map(df.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                     f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def keep_recognised(df: DataFrame, model: Model, text: str, least: float) -> DataFrame:
    """The rows of ``df`` whose text is in a language, with a score of at least ``least``; columns stay as they are."""
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, part in text_slices(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                lang, score = shipped.value.predict(part)
                keep += [x != UNKNOWN and s >= least for x, s in zip(lang, score.tolist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return arrow_map(df, run, df.schema)
