"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every labelled text in one distributed pass (dense counters in each
task, summed by language and bucket), and the resulting log-probability matrix, languages x
buckets whatever the corpus, is broadcast.  Scoring gathers the matrix entries of each text's
n-grams and sums them per text in numpy.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import set_aside
from .streams import text_slices
from .workers import lean, resident, vacate

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 1024
UNKNOWN = "und"
_MULTIPLIERS = (2654435761, 2246822519, 3266489917, 668265263, 374761393)


def _grams(texts: list[str], buckets: int, orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram of the lower-cased texts, one text after the
    other, and the number of n-grams of each text."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    ends = np.cumsum(lengths)
    for n in orders:
        size = max(len(points) - n + 1, 0)
        h = np.full(size, (n * 0x9E3779B1) & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h ^= points[k : k + size] * np.uint32(_MULTIPLIERS[k])
            h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(0x85EBCA6B)
        h = (h >> np.uint32(15)) % np.uint32(buckets)
        if n > 1:  # n-grams that reach into the next text do not count
            keep = np.ones(size, dtype=bool)
            for k in range(1, n):
                at = ends - k
                keep[at[(at >= 0) & (at < size)]] = False
            h = h[keep]
        yield h, np.maximum(lengths - n + 1, 0)


def _segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts))
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        out[full] = np.add.reduceat(values, starts)
    return out


class LanguageModel:
    """A fitted model: sorted languages and their log-probability matrix."""

    def __init__(self, languages: list[str], matrix: np.ndarray, priors: np.ndarray, orders: tuple[int, ...]):
        self.languages, self.matrix, self.priors, self.orders = languages, matrix, priors, orders

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text.  Null, or without a letter: und, 0;
        so is everything where nothing was learned.  A tie goes to the first language."""
        lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
        given = [t for t, ok in zip(texts, lettered) if ok]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not given or not self.languages:
            return names, scores
        total = np.tile(self.priors[:, None], (1, len(given)))
        for buckets, counts in _grams(given, self.matrix.shape[1], self.orders):
            for k in range(len(self.languages)):
                total[k] += _segment_sums(self.matrix[k][buckets], counts)
        best = total.argmax(axis=0)
        part = np.exp(total - total.max(axis=0))
        sure = part.max(axis=0) / part.sum(axis=0)
        where = np.flatnonzero(lettered)
        for i, k in zip(where.tolist(), best.tolist()):
            names[i] = self.languages[k]
        scores[where] = sure
        return names, scores


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", *, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, smoothing: float = SMOOTHING, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit on every row whose text and label are not null.  The model is max_languages x buckets
    numbers at most; more labels than that raise ValueError."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        sums: dict[str, np.ndarray] = {}
        rows_of: dict[str, int] = {}
        for batch in lean(batches):
            labels = np.asarray(batch.column(1).to_pylist(), dtype=object)
            for lo, hi in text_slices(batch.column(0), 1 << 20):
                texts = np.asarray(batch.column(0).slice(lo, hi - lo).to_pylist(), dtype=object)
                for label in set(labels[lo:hi]):
                    mine = texts[labels[lo:hi] == label].tolist()
                    if label not in sums:
                        if len(sums) >= max_languages:
                            raise ValueError(f"more than {max_languages} languages")
                        sums[label], rows_of[label] = np.zeros(buckets, dtype=np.int64), 0
                    rows_of[label] += len(mine)
                    for found, _ in _grams(mine, buckets, orders):
                        sums[label] += np.bincount(found, minlength=buckets)
        for label, dense in sums.items():
            at = np.flatnonzero(dense)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * (len(at) + 1), pa.string()), pa.array([-1, *at.tolist()], pa.int32()), pa.array([rows_of[label], *dense[at].tolist()], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    labelled = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counts = labelled.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    position = {label: k for k, label in enumerate(languages)}
    dense, docs = np.zeros((len(languages), buckets)), np.zeros(len(languages))
    who = np.fromiter((position[x] for x in names), dtype=np.int64, count=len(names))
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    head = bucket < 0
    docs[who[head]] = n[head]
    dense[who[~head], bucket[~head]] = n[~head]
    dense += smoothing
    matrix = np.log(dense) - np.log(dense.sum(axis=1, keepdims=True))
    priors = np.log(docs) - np.log(docs.sum()) if len(languages) else docs
    return LanguageModel(languages, matrix, priors, tuple(orders))


def identify(spark: SparkSession, model: LanguageModel):
    """A column function: text to struct<lang_pred string, score double>."""
    packed, key = spark.sparkContext.broadcast(pickle.dumps(model)), uuid.uuid4().hex

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = resident(key, lambda: pickle.loads(packed.value))
        for column in lean(batches):
            names: list[str] = []
            scores = []
            for lo, hi in text_slices(column, 1 << 20):
                found, sure = own.predict(column.slice(lo, hi - lo).to_pylist())
                names += found
                scores.append(sure)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["lang_pred", "score"]
            )

    return predict.asNondeterministic()  # so that a filter on its result does not predict twice


def held_out(doc_id: Column | str, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id counts as the empty text."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return (F.crc32(F.encode(text, "utf-8")) % folds) == fold


def language_id(docs: DataFrame, train: DataFrame | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with columns lang_pred and score added (columns of those names are replaced), by a
    model fitted on train (default: docs).

    Null texts and texts without a letter get und and 0; empty training gives und throughout; ties
    go to the first language in order; texts of any length are read whole, in slices of about a MB;
    repeated rows get equal results; other columns, whatever their names, stay as they are; the
    label column of docs is not read for predictions.
    """
    model = fit(docs if train is None else train, text, lang)
    predict = identify(docs.sparkSession, model)
    rest, back = set_aside(docs.drop("lang_pred", "score"), ("_language",))
    found = rest.withColumn("_language", predict(F.col(text))).select("*", "_language.lang_pred", "_language.score")
    return back(found.drop("_language"))
