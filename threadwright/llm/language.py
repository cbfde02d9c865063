"""Language identification by nearest centroid.

Texts become L2-normalised TF-IDF vectors over hashed byte n-grams of the lower-cased text. Each
language keeps several centroids (spherical k-means over a bounded, documented sample of labelled
texts); a text takes the language of the centroid with the highest cosine and is *rejected* when
even that one is too far away. A text of few distinct n-grams is far from every centroid by nature:
below ``FREE_GRAMS`` of them none is rejected by distance, and from there the least cosine rises in
proportion to their number, up to ``min_cosine`` at ``FULL_GRAMS``.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is
everything when there is nothing to learn from. Nulls in ``lang`` are not learned from. Ties go to
the language that sorts first. Repeated rows are scored alike. Other columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_chunks, utf8

UND = "und"
GRAMS = (2, 3)
FREE_GRAMS, FULL_GRAMS = 24, 300
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # letters, and numbers that are not digits
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def has_letter(text: str | None) -> bool:
    """Whether a character is in one of Unicode's letter categories (fractions and Roman numerals are not)."""
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text or ""))


@dataclass(frozen=True)
class LanguageModel:
    """``centroids`` holds unit vectors of the languages in ``langs`` (one entry per centroid)."""

    langs: tuple[str, ...]
    centroids: np.ndarray
    idf: np.ndarray
    min_cosine: float


def _grams(column: pa.Array, dims: int) -> np.ndarray:
    """Square roots of n-gram counts, one row per text."""
    data, offsets = utf8(pc.utf8_lower(column))
    rows = len(offsets) - 1
    counts = np.zeros(rows * dims, np.int64)
    if not len(data):
        return counts.reshape(rows, dims).astype(np.float32)
    codes = _FOLD[data]
    lead = np.repeat(np.arange(rows, dtype=np.int64) * dims, np.diff(offsets))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for size in GRAMS:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        code, blank = np.full(n, size, np.uint32), codes[:n] == 32
        for i in range(size):
            part = codes[i : i + n]
            code = code * np.uint32(16777619) + part
            if i:
                blank &= part == 32
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(12)
        fine = ~blank & (room[:n] >= size)
        counts += np.bincount(lead[:n][fine] + (code[fine] % np.uint32(dims)), minlength=rows * dims)
    return np.sqrt(counts.reshape(rows, dims).astype(np.float32))


def _blocks(batch: pa.RecordBatch, column: str, dims: int, rows: int = 128) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield part, _grams(part.column(column), dims)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _spherical_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical k-means with farthest-point starts; ``x`` has unit rows."""
    centres = [int(np.random.default_rng(seed).integers(len(x)))]
    near = x @ x[centres[0]]
    while len(centres) < min(k, len(x)):
        centres.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[centres[-1]])
    c = x[centres]
    for _ in range(rounds):
        home = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        c = np.where((np.bincount(home, minlength=len(c)) > 0)[:, None], _unit(sums), c)
    return c


def fit_language_model(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 800,
    centroids_per_language: int = 4,
    dims: int = 8192,
    min_cosine: float = 0.12,
    seed: int = 7,
) -> LanguageModel:
    """Learn from at most ``docs_per_language`` rows of each language, chosen by a hash of the id.

    Languages are a closed vocabulary, so the chosen ids are a bounded list and the model is a few
    vectors. The choice ranks ids only, after a filter by hash that leaves a few times the rows
    wanted; texts are fetched for the chosen rows.
    """
    named = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy("__l").orderBy("__h", "__i")
    ids = named.select(F.col(lang_col).alias("__l"), F.col(id_col).alias("__i")).withColumn("__h", F.xxhash64(F.lit(seed), "__i"))
    # a few times the rows wanted pass by their hash, so a language of any size sends few to its window
    sizes = ids.groupBy("__l").agg(F.count(F.lit(1)).alias("__size"))
    luck = F.pmod(F.xxhash64("__h"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    chosen = (
        ids.join(F.broadcast(sizes), "__l")
        .filter(luck * F.col("__size") < 4.0 * docs_per_language)
        .withColumn("__n", F.row_number().over(order))
        .filter(F.col("__n") <= docs_per_language)
        .select("__l", "__i")
        .distinct()
    )
    rows = named.select(F.col(lang_col).alias("__l"), F.col(id_col).alias("__i"), F.col(text_col).alias("__t"))
    sample = staged(rows.join(F.broadcast(chosen), ["__l", "__i"]).select("__l", "__t"), "language-sample")

    def document_frequency(batches):
        total, n = np.zeros(dims, np.int64), 0
        for batch in text_chunks(batches, "__t"):
            for part, grams in _blocks(batch, "__t", dims):
                total += (grams > 0).sum(axis=0)
                n += part.num_rows
        yield pa.RecordBatch.from_pydict({"gram": np.arange(dims + 1), "n": np.append(total, n)})

    counted = sample.mapInArrow(document_frequency, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    df = np.zeros(dims + 1)
    for gram, n in counted.collect():  # dims + 1 rows
        df[gram] = n
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    def centres(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        texts = group.column("__t").combine_chunks()
        x = np.concatenate([_grams(texts.slice(i, 128), dims) for i in range(0, len(texts), 128)])
        x = _unit(x * idf)
        x = x[np.lexsort(x[:, :8].T)]  # the order rows arrive in does not matter
        c = _spherical_means(x, centroids_per_language, 12, seed)
        return pa.table({"lang": [key[0].as_py()] * len(c), "centre": pa.array(c.astype(np.float32).tolist(), pa.list_(pa.float32()))})

    found = sample.groupBy("__l").applyInArrow(centres, "lang string, centre array<float>").collect()
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    vectors = np.array([r["centre"] for r in found], np.float32).reshape(len(found), dims)
    return LanguageModel(tuple(r["lang"] for r in found), vectors, idf, min_cosine)


def identify_language(
    df: DataFrame, model: LanguageModel, text_col: str = "text", columns: Sequence[str] | None = None
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine to the nearest centroid) and ``rejected``.

    ``columns`` names what to pass through (all by default); columns called like an added one are
    replaced.
    """
    added = ["lang_pred", "score", "rejected"]
    base = df.drop(*added)
    kept = [c for c in (base.columns if columns is None else columns) if c not in added]
    schema = T.StructType([base.schema[c] for c in kept]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    dims = len(model.idf)

    def predict(batches):
        langs = np.array(model.langs, dtype=object)
        for batch in text_chunks(batches, text_col):
            for part, grams in _blocks(batch, text_col, dims):
                texts = part.column(text_col).to_pylist()
                letters = np.array([has_letter(t) for t in texts], dtype=bool)
                if len(langs):
                    cosine = _unit(grams * model.idf) @ model.centroids.T
                    best = np.argmax(cosine, axis=1)
                    score = np.where(letters, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
                    names = np.where(letters, langs[best], UND)
                else:
                    score, names = np.zeros(len(texts)), np.full(len(texts), UND, dtype=object)
                distinct = np.count_nonzero(grams, axis=1)
                least = np.where(distinct < FREE_GRAMS, 0.0, model.min_cosine * np.minimum(distinct / FULL_GRAMS, 1.0))
                rejected = ~letters | (score < least)
                columns = [*(part.column(c) for c in kept), pa.array(list(names), pa.string()), pa.array(score.astype(np.float64)), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return base.mapInArrow(predict, schema)
