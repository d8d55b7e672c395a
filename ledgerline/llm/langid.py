"""Language identification with blended-spectrum string kernels.

The kernel of two texts compares which character n-grams occur in both (presence, not counts), for
n = 1, 2 and 3: ``k(x, y) = mean over n of |G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|)``. A Nystroem
map over landmark texts makes it a finite feature space, in which one-versus-rest kernel ridge
regression is solved. Texts are scored in batches by matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import release_memory, tidy

ORDERS = (1, 2, 3)
UNKNOWN = "und"
BATCH = 128
SALTS = 64
_BITS = 21  # of a code point; three of them fit a 64-bit key, so n-grams are exact


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def spectrum(text: str | None) -> list[np.ndarray] | None:
    """The distinct n-grams of the lower-cased text by n, runs of non-letters being one space; None without letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    points = np.concatenate([[32], np.where(is_letter, points, 32), [32]])
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    grams = [points, (points[:-1] << _BITS) | points[1:]]
    grams.append((grams[1][:-1] << _BITS) | points[2:])
    return [np.unique(g) for g in grams]


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray]       # by n: the landmarks' n-grams, sorted
    presence: list[np.ndarray]   # by n: [n-gram, landmark], scaled by the landmark's norm
    weights: np.ndarray          # [landmark, language]
    bias: np.ndarray

    def kernel(self, spectra: list[list[np.ndarray]]) -> np.ndarray:
        """Kernel values [text, landmark]: one matrix product per n for the whole batch."""
        out = np.zeros((len(spectra), self.weights.shape[0]), dtype=np.float32)
        for n, (keys, presence) in enumerate(zip(self.keys, self.presence)):
            grams = np.concatenate([s[n] for s in spectra])
            row = np.repeat(np.arange(len(spectra)), [len(s[n]) for s in spectra])
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            known = keys[at] == grams
            x = np.zeros((len(spectra), len(keys)), dtype=np.float32)
            x[row[known], at[known]] = 1
            norm = np.sqrt(np.array([len(s[n]) for s in spectra], dtype=np.float32))
            out += x @ presence / norm[:, None]
        return out / len(self.keys)

    def scores(self, spectra: list[list[np.ndarray]]) -> np.ndarray:
        return self.kernel(spectra) @ self.weights + self.bias


def _landmark_presence(spectra: list[list[np.ndarray]]):
    keys, presence = [], []
    for n in range(len(ORDERS)):
        k = np.unique(np.concatenate([s[n] for s in spectra]))
        m = np.zeros((len(k), len(spectra)), dtype=np.float32)
        for j, s in enumerate(spectra):
            m[np.searchsorted(k, s[n]), j] = 1 / np.sqrt(len(s[n]))
        keys.append(k)
        presence.append(m)
    return keys, presence


def fit(languages: list[str], spectra: list[list[np.ndarray]], n_landmarks: int = 128, ridge: float = 1e-3) -> Model | None:
    """Ridge regression on Nystroem features; landmarks are taken from all languages in turn. None without rows."""
    if not languages:
        return None
    names = sorted(set(languages))
    by_language = [[i for i, x in enumerate(languages) if x == name] for name in names]
    turns = [own[j] for j in range(max(map(len, by_language))) for own in by_language if j < len(own)]
    keys, presence = _landmark_presence([spectra[i] for i in turns[:max(n_landmarks, len(names))]])
    model = Model(names, keys, presence, np.zeros((presence[0].shape[1], len(names)), np.float32), np.zeros(len(names), np.float32))
    landmarks = [spectra[i] for i in turns[:max(n_landmarks, len(names))]]
    values, vectors = np.linalg.eigh(model.kernel(landmarks).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    kernel = np.vstack([model.kernel(spectra[i:i + BATCH]) for i in range(0, len(spectra), BATCH)])
    features = kernel.astype(np.float64) @ to_features
    targets = np.array([[1.0 if x == name else -1.0 for name in names] for x in languages])
    weight = np.array([1 / len(by_language[names.index(x)]) for x in languages])  # each language counts alike
    weight /= weight.sum()
    mean_f, mean_t = weight @ features, weight @ targets
    centred = features - mean_f
    gram = centred.T @ (centred * weight[:, None]) + ridge * np.eye(centred.shape[1])
    solved = np.linalg.solve(gram, centred.T @ ((targets - mean_t) * weight[:, None]))
    model.weights = (to_features @ solved).astype(np.float32)
    model.bias = (mean_t - mean_f @ solved).astype(np.float32)
    return model


def _spectra_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(lang, s) for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()) if (s := spectrum(t))]
        for i in range(0, len(rows), 64):
            part = rows[i:i + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in part], pa.string()),
                 pa.array([np.concatenate(s).tobytes() for _, s in part], pa.binary()),
                 pa.array([[len(g) for g in s] for _, s in part], pa.list_(pa.int32()))], names=["lang", "grams", "sizes"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = 300, n_landmarks: int = 128) -> Model | None:
    """Fit on at most ``rows_per_language`` rows of each language, the first by a hash of id and text.

    Rows with a null language, null text or no letter teach nothing. The sample's distinct n-grams, not
    its texts, go to the driver. Returns None when nothing is labelled.
    """
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")
                           ).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("turn", F.xxhash64("id", "text"))
    chosen = rows.filter(F.col("text").rlike(r"\p{L}")).select("lang", "turn").distinct()
    for group in (["lang", F.pmod("turn", F.lit(SALTS))], ["lang"]):  # a language's rows first in salted groups
        place = F.row_number().over(Window.partitionBy(*group).orderBy("turn"))
        chosen = chosen.withColumn("place", place).filter(F.col("place") <= rows_per_language).drop("place")
    # At most rows_per_language short rows for each language: bounded, whatever the table.
    sample = rows.join(F.broadcast(chosen), ["lang", "turn"]).dropDuplicates(["lang", "turn"]).select("lang", "text")
    got = sample.mapInArrow(tidy(_spectra_batches), "lang string, grams binary, sizes array<int>").collect()
    got = sorted(((r["lang"], bytes(r["grams"]), r["sizes"]) for r in got), key=lambda r: r[:2])
    spectra = [np.split(np.frombuffer(g, dtype=np.int64), np.cumsum(sizes)[:-1]) for _, g, sizes in got]
    return fit([lang for lang, _, _ in got], spectra, n_landmarks)


def predicted(df: DataFrame, model: Model | None, text_col: str = "text"):
    """Column struct<lang_pred string, score double> for ``text_col``.

    Null texts and texts without a letter are ``und`` with score 0, as is every text when nothing was
    learned. The score is the winner's regression value brought from [-1, 1] to [0, 1]; ties go to the
    first language in order. Whole texts count, however long.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for start in range(0, len(texts) if model else 0, BATCH):
                found = [(start + i, s) for i, t in enumerate(texts.iloc[start:start + BATCH]) if (s := spectrum(t))]
                if found:
                    values = model.scores([s for _, s in found])
                    best = values.argmax(axis=1)
                    for (i, _), j, row in zip(found, best, values):
                        langs[i], scores[i] = model.languages[j], min(1.0, max(0.0, (float(row[j]) + 1) / 2))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})
        release_memory()

    # Otherwise a filter on the prediction would be pushed below it, as a second evaluation in the same task.
    return run.asNondeterministic()(F.col(f"`{text_col}`"))
