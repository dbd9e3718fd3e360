"""Language identification in two steps: the language family first, then
one-versus-one linear support vector machines between the languages of that
family.

Features are hashed byte pairs and triples of the whole text.  The machines are
fitted on a bounded sample (``per_language`` labelled rows of each language, by
default 300); every row of the table is then scored in its own task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import LOWER, lean, text_steps
from refinery.session import materialize

# Families of common languages; a language not listed is a family of its own.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic",
    "sl": "slavic", "sr": "slavic", "uk": "slavic",
}
UNDETERMINED = "und"
PER_LANGUAGE = 300           # labelled rows of each language that training sees
DIM = 4096
STEP_TEXTS = 256             # texts whose features are in memory at once

# Letters and all bytes of other scripts keep their value, the rest is a space.
_PLAIN = np.array([b if b >= 0x80 or 97 <= b <= 122 else 32 for b in LOWER.tolist()], np.uint64)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit vectors (texts x DIM, float32): square roots of the counts of
    hashed byte pairs (first quarter) and triples; spaces count once in a row."""
    n, b = len(offsets) - 1, _PLAIN[data]
    counts = np.zeros((n, DIM), np.float32)
    if len(b):
        doc = np.repeat(np.arange(n), np.diff(offsets))
        keep = np.ones(len(b), bool)
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (doc[1:] != doc[:-1])
        b, doc = b[keep], doc[keep]
        for k, (low, width) in ((2, (0, DIM // 4)), (3, (DIM // 4, DIM - DIM // 4))):
            m = len(b) - k + 1
            if m <= 0:
                continue
            gram = b[:m].copy()
            for j in range(1, k):
                gram = gram * np.uint64(257) + b[j:j + m]
            slot = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(width)
            whole = doc[:m] == doc[k - 1:k - 1 + m]
            at = doc[:m][whole] * width + slot[whole].astype(np.int64)
            counts[:, low:low + width] += np.bincount(at, minlength=n * width).reshape(n, width)
    x = np.sqrt(counts)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    low = LOWER[data]
    ascii_letters = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def vectors(batch: pa.RecordBatch, column: str) -> Iterator[tuple]:
    """(first row, has a letter, feature rows) in steps of a bounded size."""
    for lo, hi, data, off in text_steps(batch, column):
        for at in range(0, hi - lo, STEP_TEXTS):
            o = off[at:at + STEP_TEXTS + 1]
            d = data[o[0]:o[-1]]
            yield lo + at, has_letter(d, o - o[0]), features(d, o - o[0])


# --- the model -----------------------------------------------------------------------------------

def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of a linear SVM with squared hinge loss; y is +1 or
    -1 and both classes count alike.  Accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    step = 1 / (penalty + 4.0)                     # rows are unit vectors and a one
    w = z = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ z)) * weight
        new = z - step * (penalty * z - 2 * ((y * slack) @ x))
        w, z = new, new + (k / (k + 3)) * (new - w)
    return w


@dataclass
class Duels:
    """One-versus-one machines between ``classes``."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray) -> Duels:
        classes = sorted(set(label))
        pairs = list(itertools.combinations(range(len(classes)), 2))
        made = []
        for a, b in pairs:
            of = (label == classes[a]) | (label == classes[b])
            made.append(fit_svm(x[of], np.where(label[of] == classes[a], 1.0, -1.0).astype(np.float32)))
        return cls(classes, pairs, np.array(made, np.float32).T if made else None)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class number, score): the class with most duels won, ties by the sum
        of margins; the score is the winner's least certain duel, 0.5 to 1."""
        if self.weights is None:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margin = x @ self.weights[:-1] + self.weights[-1]
        votes = np.zeros((len(x), len(self.classes)))
        least = np.full((len(x), len(self.classes)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            for c, m in ((a, margin[:, k]), (b, -margin[:, k])):
                votes[:, c] += (m > 0) + np.tanh(m) / (4 * len(self.classes))
                least[:, c] = np.minimum(least[:, c], m)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-3 * np.clip(least[np.arange(len(x)), best], 0, 9)))


@dataclass
class Model:
    family: Duels
    within: dict[str, Duels]

    @classmethod
    def fit(cls, x: np.ndarray, lang: np.ndarray, families: dict[str, str]) -> Model:
        of = np.array([families.get(v, v) for v in lang], object)
        top = Duels.fit(x, of)
        return cls(top, {f: Duels.fit(x[of == f], lang[of == f]) for f in top.classes})

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        fam, score = self.family.predict(x)
        lang = np.empty(len(x), object)
        for k, name in enumerate(self.family.classes):
            rows = np.flatnonzero(fam == k)
            best, s = self.within[name].predict(x[rows])
            lang[rows] = [self.within[name].classes[i] for i in best]
            score[rows] *= s
        return lang.tolist(), score


def train(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id",
          per_language: int = PER_LANGUAGE, families: dict[str, str] | None = None, seed: int = 5) -> Model | None:
    """Fit on about ``per_language`` rows of each language (twice as many at
    most), drawn by a seeded hash; None without any labelled row with letters.
    Rows without a label or text are left out."""
    rows = labelled.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text"),
        F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)).alias("draw"))
    counts = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    languages = counts.count()
    span = F.lit(2.0 ** 63)
    drawn = (rows.join(counts, "lang").filter(F.col("draw").cast("double") / span <= F.lit(2.0 * per_language) / F.col("n") - 1)
             .select("lang", "text").limit(2 * per_language * max(1, languages)))

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, letters, x in vectors(batch, "text"):
                keep = np.flatnonzero(letters)
                yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(keep + at)),
                                                  pa.array([x[i].astype(np.float16).tobytes() for i in keep], pa.binary())], ["lang", "x"])

    got = drawn.mapInArrow(vectorise, "lang string, x binary").toPandas()
    if got.empty:
        return None
    got = got.sort_values(["lang", "x"])                       # the same order in every run
    x = np.stack([np.frombuffer(b, np.float16) for b in got["x"]]).astype(np.float32)
    return Model.fit(x, got["lang"].to_numpy(object), FAMILIES if families is None else families)


def identify(docs: DataFrame, model: Model | None, text_column: str = "text",
             carry: dict[str, Column] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``carry`` columns of every row with ``lang_pred`` and ``score``.
    ``und`` with score 0 where the text is null or has no letter, or there is
    no model.  No column but the text decides."""
    carry = carry or {}
    rows = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(carry.values())], F.col(text_column).alias("text"))
    kept = [f"c{i}" for i in range(len(carry))]
    schema = ", ".join([f"{c} {t}" for c, t in rows.dtypes if c != "text"] + ["lang_pred string", "score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)    # languages^2 / 2 weight vectors at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            lang = np.full(batch.num_rows, UNDETERMINED, object)
            value = np.zeros(batch.num_rows)
            for at, letters, x in vectors(batch, "text") if m is not None else ():
                rows_ = np.flatnonzero(letters)
                got, s = m.predict(x[rows_])
                lang[rows_ + at], value[rows_ + at] = got, s
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(lang, pa.string()), pa.array(value)],
                                             [*kept, "lang_pred", "score"])

    out = rows.mapInArrow(lambda batches: lean(score(batches)), schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(carry)],
                      F.col("lang_pred").alias(names[0]), F.col("score").alias(names[1]))


def with_letter(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows whose text has a letter of any script; no model decides."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, bool)
            for lo, hi, data, off in text_steps(batch, text_column):
                found[lo:hi] = has_letter(data, off)
            yield batch.filter(pa.array(found))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_column: str = "doc_id") -> Column:
    """The third of the ids that training never sees (a null id is in it not)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on_open_part(docs: DataFrame, **options) -> Model | None:
    """Fit on the rows outside ``held_out``; rows without an id are not used."""
    return train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()), **options)
