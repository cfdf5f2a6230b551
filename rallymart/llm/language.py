"""Language identification by the nearest of several centroids for each language.

A text is the vector of its hashed two- and three-byte runs of lower-cased letters, square root
of the count times inverse document frequency, of length one. Each language has some centroids,
clusters of its training texts by cosine. The language of the nearest centroid wins; a text that
is much farther from it than pieces of that language's training texts as long as it is rejected.

The classifier is fitted on a bounded sample, about `SAMPLE` labelled texts of each language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_pass, sent, small, stage, texts

#: Labelled texts of a language that the classifier is fitted on, at most.
SAMPLE = 500
CENTROIDS = 3
FEATURES = 8192
ROUNDS = 10
#: Letters from which on a text belongs to a band. Short texts reach less likeness, so each band of
#: a language has a limit of its own, measured on pieces of that length of its training texts.
BANDS = (4, 16, 64, 256, 1024)
#: A text is rejected below this part of the likeness that all but a few pieces reach.
FAR, FEW = 0.45, 0.05
#: Pieces that a limit rests on at least; else that of the band below holds.
LEAST_PIECES = 20
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 3 == 1


def counts(text: str) -> np.ndarray:
    """How often each feature is in the text."""
    raw = np.frombuffer(f" {_OTHER.sub(' ', text.lower()).strip()} ".encode(), "uint8").astype("uint32")
    two = raw[:-1] << np.uint32(8) | raw[1:]
    three = two[:-1] << np.uint32(8) | raw[2:]
    hashed = np.concatenate([two + np.uint32(1 << 24), three]) * np.uint32(2654435761)
    return np.bincount(hashed >> np.uint32(19), minlength=FEATURES)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    return _weighted(counts(text), idf)


def _weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.sqrt(found) * idf
    return weighted / (np.linalg.norm(weighted) or 1.0)


def limits(said: list[str], centroids: np.ndarray, idf: np.ndarray) -> list[float]:
    """For each band the likeness below which a text of this language's centroids is rejected."""
    made: list[float] = []
    for letters in BANDS:
        # A piece of each training text that is long enough, from somewhere inside it.
        pieces = [t[(len(t) - letters) // 3 :][:letters] for t in said if len(t) >= letters]
        pieces = [p for p in pieces if _LETTER.search(p)]
        if len(pieces) < LEAST_PIECES:
            made.append(made[-1] if made else 0.0)
            continue
        reached = (np.stack([vector(p, idf) for p in pieces]) @ centroids.T).max(axis=1)
        made.append(FAR * float(np.quantile(reached, FEW)))
    return made


def clusters(vectors: np.ndarray, number: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length one by spherical k-means; each starts at the farthest text so far."""
    chosen = [0]
    while len(chosen) < min(number, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) for i in range(len(centroids))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    return centroids


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # likeness below which a text is rejected, for each centroid and band

    def classify(self, text: str) -> tuple[str, float, bool]:
        """The language, its likeness from 0 to 1, and whether the text is rejected."""
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        found = counts(text)
        likeness = self.centroids @ _weighted(found, self.idf)
        best = int(likeness.argmax())
        score = float(min(1.0, max(0.0, likeness[best])))
        # Two features to a letter, as near as it matters here.
        band = max(0, int(np.searchsorted(BANDS, found.sum() // 2, side="right")) - 1)
        return self.languages[best], score, bool(likeness[best] < self.least[best, band])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on texts with a letter and a language that are not held out.

    The sample takes rows by a hash of doc_id and text, as many of each language as are expected to
    make `sample`, equal rows once, and at most twice as many. It is read in tasks; the driver gets
    document frequencies and centroids, whose number depends on the parameters and the languages
    alone.
    """
    spark = docs.sparkSession
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = usable.groupBy("lang").count()
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_000)) / F.lit(1e9)
    first = Window.partitionBy("lang").orderBy("place", "text")
    taken = (
        usable.select("doc_id", "lang", "text")
        .join(F.broadcast(sizes), "lang")  # one row for each language
        .where(place < F.lit(float(sample)) / F.col("count"))
        .select("lang", "text", place.alias("place"))
        .distinct()
        # A limit on the rank, which Spark applies before it brings a language's rows together.
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= 2 * sample)
        .drop("_rank")
    )
    taken = stage(taken, "labelled")

    def work():
        def each(batch: pa.RecordBatch) -> dict:
            present = np.zeros(FEATURES, "int64")
            for text in texts(batch, "text"):
                present += counts(text) > 0
            return {"feature": np.arange(FEATURES), "n": present}

        return each

    present = np.zeros(FEATURES)
    found = arrow_pass(taken.select("text"), work, "feature int, n long")
    for row in found.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        present[row.feature] = row.n
    idf = np.log((1 + taken.count()) / (1 + present)) + 0.1

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "text"])
        centroids = clusters(np.stack([vector(t, idf) for t in rows["text"]]))
        least = limits(list(rows["text"]), centroids, idf)
        return pd.DataFrame(
            {"lang": rows["lang"].iloc[0], "centroid": list(centroids), "least": [least] * len(centroids)}
        )

    fitted = taken.groupBy("lang").applyInPandas(
        fit, "lang string, centroid array<double>, least array<double>"
    )
    rows = sorted(fitted.collect(), key=lambda r: (r.lang, r.centroid))
    return Model(
        idf,
        [r.lang for r in rows],
        np.array([r.centroid for r in rows]).reshape(-1, FEATURES),
        np.array([r.least for r in rows]).reshape(-1, len(BANDS)),
    )


ADDED = "lang_pred string, score double, rejected boolean"


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score and rejected; columns of these names are replaced.

    Null texts and those without a letter are `und`, with score 0, and rejected; so is every text
    if nothing could be learned. Long texts count whole. Of equally near centroids the first
    language by name wins. Repeated rows are classified each; an empty table gives no rows.
    """
    added = T._parse_datatype_string(ADDED)
    docs = docs.drop(*added.names)
    shared = sent(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared()
        for batch in small(batches):
            made = [fitted.classify(t) for t in texts(batch, "text")]
            columns = list(zip(*made, strict=True)) or [(), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *added.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))
