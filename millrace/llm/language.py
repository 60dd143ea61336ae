"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (lengths 1 to 3, the blended spectrum) that occur in
both, each counted once, divided by the root of the product of their n-gram counts. Texts are lower-cased; what is
not a letter separates. A few landmark texts (Nyström) span the feature space: phi(x) = k(x, Z) k(Z, Z)^(-1/2).
One ridge regression per language on phi, targets +1 and -1, gives the decision values.

Since k(x, Z) is the product of two 0/1 matrices, k(x, Z) A = (X B') A = X (B' A): the landmark side is folded
into one matrix of n-grams by languages on the driver, and a task scores a block of documents by one product of
its presence matrix with it. n-grams are hashed to `BUCKETS`; only those of landmarks take part in the kernel.

Fitting reads a bounded sample: the `per_language` labelled texts of each language with the smallest text hash.
A row is predicted from its text alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import mix64, table, text_chunks

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS_LOG2 = 20
PER_LANGUAGE = 300
LANDMARKS = 60
RIDGE = 1e-3
_CHUNK = 1 << 18
_SEPARATOR = 32


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...] = ()
    # Place of each hashed n-gram among the landmarks' n-grams, -1 for others.
    place: np.ndarray = field(default_factory=lambda: np.full(1 << BUCKETS_LOG2, -1, np.int32))
    # One row per landmark n-gram, one column per language.
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else the separator."""
    codes = np.arange(0x110000, dtype=np.int64)
    known = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(known, codes, _SEPARATOR)


def _spelled(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single separators of all texts in a row, the text of each, and whether a text has a letter.

    Every text begins and ends with a separator.
    """
    lowered = [f" {t.lower()} " if t else "  " for t in texts]
    codes = _letters()[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    kept = codes != _SEPARATOR
    has_letter = np.bincount(owner[kept], minlength=len(texts)) > 0
    kept[0] = True
    kept[1:] |= (codes[:-1] != _SEPARATOR) | (owner[1:] != owner[:-1])
    return codes[kept], owner[kept], has_letter


def _grams(codes: np.ndarray, owner: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one length inside single texts, and the text of each."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = np.full(n, order, np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(20)) ^ codes[k : k + n].astype(np.uint64)
    inside = owner[:n] == owner[order - 1 :]
    hashed = (mix64(packed) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)
    return hashed[inside], owner[:n][inside]


def _present(text: str) -> np.ndarray:
    """The distinct hashed n-grams of one text."""
    codes, owner, has_letter = _spelled([text])
    if not has_letter[0]:
        return np.zeros(0, np.int32)
    return np.unique(np.concatenate([_grams(codes, owner, n)[0] for n in ORDERS])).astype(np.int32)


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """(lang, grams) of the texts with the smallest hash, at most `per_language` different ones of each language."""
    spark = labelled.sparkSession
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    # Hashes are even, so the smallest ones of a language lie below a cut that follows from its number of texts.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    span = {r["lang"]: min(1.0, (2 * per_language + 100) / max(1, r["n"])) for r in sizes}
    if not span:
        return spark.createDataFrame([], "lang string, h long, grams binary")
    cuts = [(F.col("lang") == lang) & (F.col("h") <= int(part * 2**64) - 2**63 - 1) for lang, part in span.items()]
    low = rows.where(reduce(or_, cuts)).select("lang", "h").distinct().collect()
    hashes = [h for lang in span for h in sorted(r["h"] for r in low if r["lang"] == lang)[:per_language]]
    texts = rows.where(F.col("h").isin(hashes)).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def present(batches):
        for batch in batches:
            grams = [_present(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array(grams, pa.binary())], ["lang", "h", "grams"]
            )

    return texts.mapInArrow(present, "lang string, h long, grams binary")


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE
) -> LanguageModel:
    """Learn from the columns `text` and `lang`. Rows with a null in either are left out.

    Reads at most `per_language` texts of each language, and `landmarks` of these are landmarks; what reaches the
    driver is their n-gram sets. Without a usable text there are no languages and every prediction is `und`.
    """
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = sorted(_sample(usable, per_language).collect(), key=lambda r: (r["lang"], r["h"]))
    sets = [(r["lang"], np.frombuffer(r["grams"], np.int32)) for r in rows if r["grams"]]
    languages = tuple(sorted({lang for lang, _ in sets}))
    if not languages:
        return LanguageModel()
    chosen: list[int] = []
    for lang in languages:
        chosen += [i for i, (of, _) in enumerate(sets) if of == lang][:landmarks]
    vocabulary = np.unique(np.concatenate([sets[i][1] for i in chosen]))
    place = np.full(1 << BUCKETS_LOG2, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)

    presence = np.zeros((len(sets), len(vocabulary)), np.float32)
    for row, (_, grams) in enumerate(sets):
        at = place[grams]
        presence[row, at[at >= 0]] = 1
    presence /= np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
    marks = presence[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    sound = values > values.max() * 1e-6
    root = vectors[:, sound] / np.sqrt(values[sound])
    phi = (presence @ marks.T).astype(np.float64) @ root
    targets = np.where(np.array([[of == lang for lang in languages] for of, _ in sets]), 1.0, -1.0)
    gram = phi.T @ phi + ridge * len(sets) * np.eye(phi.shape[1])
    solution = root @ np.linalg.solve(gram, phi.T @ targets)
    return LanguageModel(languages, place, (marks.T.astype(np.float64) @ solution).astype(np.float32))


def _scored(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    codes, owner, has_letter = _spelled(texts)
    presence = np.zeros((len(texts), len(model.weights)), np.float32)
    for order in ORDERS:
        hashed, of = _grams(codes, owner, order)
        at = model.place[hashed]
        known = at >= 0
        presence[of[known], at[known]] = 1
    norm = np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
    values = (presence @ model.weights) / norm
    best = values.argmax(axis=1)
    score = np.clip((values[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)]
    return names, np.where(has_letter, score, 0.0).tolist()


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """The columns `keep` of `df` (all, if not given), then `lang_pred` and `score` (0 to 1).

    `und` with score 0 where the text is null, empty or without a letter, or nothing was learned. Equal texts get
    equal predictions; whole texts of any length are scored. Columns of these two names in `df` are replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))

    def predict(batches):
        fitted = held.value
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if fitted.languages:
                for start, texts in text_chunks(batch.column(len(kept)), _CHUNK):
                    end = start + len(texts)
                    names[start:end], scores[start:end] = _scored(fitted, texts)
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(predict, T.StructType([*rows.schema.fields[:-1], *added]))


def held_out(df: DataFrame):
    """Whether a document is kept from fitting: crc32 of its id as text, mod 4, is 2 (null id: not)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = fit(documents.where(~held_out(documents)))
    rows = documents.withColumn("held_out", held_out(documents))
    return identify(rows, model, keep=["doc_id", "held_out"])


QUERIES = {"op2_language": op2_language}
CHECKS: dict[str, str] = {}
