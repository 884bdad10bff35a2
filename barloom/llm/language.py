"""Language ID: nearest centroid of TF-IDF n-gram vectors.

A text is lower-cased; its runs of letters give n-grams of one to three letters (a blank on either
side of a run counts as a letter), hashed to ``2**BITS`` coordinates. The vectors of a bounded sample of
each language are clustered by spherical k-means, each language in a task of its own; a text gets the language of the centroid with the
largest cosine. A text that is farther from its centroid than ``reject`` of the sample's own texts were is
marked as rejected; a text without letters has no vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import broadcast_if_small
from barloom.scratch import settle

BITS = 15
#: Texts of each language that a fit uses at most, centroids of each language, share of a language's own texts within its radius.
ROWS_PER_LANGUAGE, CENTROIDS, WITHIN = 400, 4, 0.995
#: Bytes of all languages' centroids that the driver and a worker hold at most.
MODEL_BYTES = 256 << 20
#: What a row of a language or of a sample's id takes in a broadcast, at most about.
_ROW_BYTES = 48


def _letters() -> np.ndarray:
    """The code point of each letter of the basic plane, a blank for all others; all beyond the plane are letters."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x10000)], np.uint32)


LETTERS = _letters()


def ngram_counts(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and counts of the n-grams of a whole text."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.concatenate(([32], np.where(points < 0x10000, LETTERS[np.minimum(points, 0xFFFF)], points), [32])).astype(np.uint32)
    codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
    if len(codes) < 2:
        return np.empty(0, np.int64), np.empty(0)
    found = []
    for size in (1, 2, 3):
        h = np.full(max(len(codes) - size + 1, 0), size, np.uint32)
        for k in range(size):
            h ^= codes[k : len(codes) - size + 1 + k]
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        found.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits))
    found[0] = found[0][codes != 32]
    counts = np.bincount(np.concatenate(found), minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(float)


def spherical_kmeans(at: list[np.ndarray], values: list[np.ndarray], size: int, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of sparse unit vectors. The first is nearest to the mean; each further one starts as the
    vector that is farthest from those there are. Fewer than ``k`` if the vectors are fewer."""

    def mean(members: np.ndarray) -> np.ndarray:
        total = np.zeros(size)
        for i in members:
            total[at[i]] += values[i]
        norm = np.sqrt(total @ total)
        return total / norm if norm else total

    def cosines(centre: np.ndarray) -> np.ndarray:
        return np.array([centre[a] @ v for a, v in zip(at, values, strict=True)])

    centres = [mean(np.arange(len(at)))]
    near = [cosines(centres[0])]
    while len(centres) < min(k, len(at)):
        best = np.max(near, axis=0)
        far = int(np.argmin(best))
        if best[far] > 1 - 1e-9:
            break
        centres.append(mean(np.array([far])))
        near.append(cosines(centres[-1]))
    owner = np.argmax(near, axis=0)
    for _ in range(rounds):
        for c in range(len(centres)):
            members = np.flatnonzero(owner == c)
            if len(members):
                centres[c] = mean(members)
                near[c] = cosines(centres[c])
        new = np.argmax(near, axis=0)
        if (new == owner).all():
            break
        owner = new
    return np.array(centres)


@dataclass
class LanguageModel:
    languages: list[str]
    owner: np.ndarray  # the language of each centroid
    starts: np.ndarray  # where each coordinate's part of the next two starts, and the end
    centroid: np.ndarray  # the centroids that have a coordinate
    weight: np.ndarray  # and their values there
    idf: np.ndarray
    radius: np.ndarray  # the largest accepted distance of each language
    bits: int = BITS

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        at, counts = ngram_counts(text, self.bits)
        values = (1 + np.log(counts)) * self.idf[at] if len(at) else counts
        norm = np.sqrt(values @ values)
        return at, values / norm if norm else values

    def predict(self, text: str | None) -> tuple[str | None, float, bool]:
        """Language, cosine, and whether it is rejected; no language if there is none to learn from or no vector."""
        at, values = self.vector(text)
        if not len(at) or not self.languages:
            return None, 0.0, True
        first, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        taken = np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)
        cosines = np.bincount(self.centroid[taken], np.repeat(values, sizes) * self.weight[taken], len(self.owner))
        best = int(np.argmax(cosines))
        cosine = float(min(max(cosines[best], 0.0), 1.0))
        return self.languages[self.owner[best]], cosine, bool(1 - cosine > self.radius[self.owner[best]])


def fit_language(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, k: int = CENTROIDS, within: float = WITHIN) -> tuple[np.ndarray, float]:
    """The centroids of one language and its radius, from the coordinates and counts of its texts; none has no coordinates."""
    own = [(at, (1 + np.log(counts)) * idf[at]) for at, counts in rows]
    vectors = [v / np.sqrt(v @ v) for _, v in own]
    centres = spherical_kmeans([at for at, _ in own], vectors, len(idf), k)
    best = [max(float(v @ c[at]) for c in centres) for (at, _), v in zip(own, vectors, strict=True)]
    return centres, 1 - float(np.quantile(best, 1 - within))


def train_languages(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, bits: int = BITS, k: int = CENTROIDS, model_bytes: int = MODEL_BYTES
) -> LanguageModel:
    """Fit on the rows with a language, at most ``rows_per_language`` of each: those with the smallest hash of
    their id. Null languages and null ids are left out. Repeated ids count once in the choice of ids, and each of their rows up to the bound.
    Every language is learned; the driver and each worker hold the centroids of all, sparse, and more than ``model_bytes`` of them are an error. An
    empty table gives a model without languages, which predicts none."""
    rows = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    known = rows.where("lang is not null and id is not null and text is not null")
    every = broadcast_if_small(known.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")), _ROW_BYTES)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # Ids first: only the texts of the sample are carried further. A threshold on the hash leaves about four times
    # as many ids as are wanted, however frequent a language is.
    near = known.select("lang", "id").join(every, "lang").where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) * F.col("n") < float(4 * rows_per_language * (1 << 31)))
    chosen = near.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= rows_per_language)
    chosen = broadcast_if_small(settle(chosen.select("lang", "id").distinct()), _ROW_BYTES)

    def counted(batches):
        for frame in batches:
            pairs = [ngram_counts(x, bits) for x in frame["text"]]
            yield pd.DataFrame(
                {
                    "lang": frame["lang"],
                    "id": frame["id"].astype(str),
                    "at": [a.astype("<u4").tobytes() for a, _ in pairs],
                    "counts": [c.astype("<f4").tobytes() for _, c in pairs],
                }
            )

    capped = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("at", "counts"))
    sample = settle(
        known.join(chosen, ["lang", "id"])
        .select("lang", "id", "text")
        .mapInPandas(counted, "lang string, id string, at binary, counts binary")
        .withColumn("turn", F.row_number().over(capped))
        .where(F.col("turn") <= rows_per_language)
        .select("lang", "turn", "at", "counts")
    )

    def coordinates(batches):
        total = np.zeros(1 << bits, np.int64)
        for frame in batches:
            for x in frame["at"]:
                total[np.frombuffer(x, "<u4")] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    seen = np.zeros(1 << bits)
    for r in sample.select("at").mapInPandas(coordinates, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        seen[r["at"]] = r["n"]
    idf = np.log((1 + sample.count()) / (1 + seen)) + 1

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("turn")
        rows = [(np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(c, "<f4").astype(float)) for a, c in zip(frame["at"], frame["counts"], strict=True)]
        centres, radius = fit_language(rows, idf, k)
        nonzero = [np.flatnonzero(c) for c in centres]
        return pd.DataFrame(
            {
                "lang": frame["lang"].iloc[0],
                "number": range(len(centres)),
                "at": [x.astype("<u4").tobytes() for x in nonzero],
                "weight": [c[x].astype("<f8").tobytes() for c, x in zip(centres, nonzero, strict=True)],
                "radius": radius,
            }
        )

    found = settle(sample.where("length(at) > 0").groupBy("lang").applyInPandas(fit, "lang string, number int, at binary, weight binary, radius double"))
    size = found.agg(F.sum(F.octet_length("at") + F.octet_length("weight") + F.octet_length("lang") + 64)).first()[0] or 0
    if size > model_bytes:
        raise ValueError(f"the centroids of all languages take {size} bytes; at most {model_bytes} are held by the driver")
    fitted = found.collect()
    fitted.sort(key=lambda r: (r["lang"], r["number"]))
    learned = sorted({r["lang"] for r in fitted})
    place = {lang: n for n, lang in enumerate(learned)}
    radius = {r["lang"]: r["radius"] for r in fitted}
    at = np.concatenate([np.frombuffer(r["at"], "<u4").astype(np.int64) for r in fitted] or [np.empty(0, np.int64)])
    weight = np.concatenate([np.frombuffer(r["weight"], "<f8") for r in fitted] or [np.empty(0)])
    centroid = np.repeat(np.arange(len(fitted)), [len(r["at"]) // 4 for r in fitted])
    order = np.argsort(at, kind="stable")
    starts = np.searchsorted(at[order], np.arange((1 << bits) + 1))
    owner = np.array([place[r["lang"]] for r in fitted], int)
    return LanguageModel(learned, owner, starts, centroid[order].astype(np.int32), weight[order], idf, np.array([radius[x] for x in learned]), bits)


def language_of(model: LanguageModel, text: Column) -> Column:
    """A struct of lang, score (the cosine) and rejected for each text. Null and empty texts, and texts without a known n-gram, have no language; so
    has every text of a model without languages. Repeated texts have the same result."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = LanguageModel(**shared.value)
        return pd.DataFrame([own.predict(x) for x in texts], columns=["lang", "score", "rejected"])

    return predict(text)
