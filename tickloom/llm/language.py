"""Language identification in two steps: the family first, then one-versus-one linear support vector
machines between the languages of that family.

Each family and each pair of languages is a model of its own, fitted by a task of its own on the rows of a
bounded sample that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import remainder, stage, unstage
from tickloom.llm.features import Sparse, dot, feature_rows, fit_linear, one_text_each, rows_of, sampled, sigmoid, sparse_of, text_features
from tickloom.llm.tokens import in_slices

#: Families of languages that are written alike; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg sr hr bs sl cs sk pl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky",
    "indic": "hi mr ne bn gu pa",
    "semitic": "ar he fa ur",
    "malayic": "id ms",
    "sinitic": "zh ja ko",
}
CHARS, BITS = (1, 2, 3), 13
#: Margins of support vector machines become probabilities at this slope.
SLOPE = 3.0


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, langs in FAMILIES.items() if code in langs.split()), f"only {lang}")


def jobs_of(langs: list[str]) -> tuple[dict[str, list[str]], list[tuple[str, str, str, float, float]]]:
    """Languages by family, and what is to be fitted: (family or first language, second language, language of the
    rows, class, share of the rows). Families are told apart on about the rows of one or two languages each."""
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        families.setdefault(family_of(lang), []).append(lang)
    jobs = []
    if len(families) > 1:
        jobs += [(f, "", lang, float(lang in families[f]), min(1.0, 2.0 / len(members))) for f in families for members in families.values() for lang in members]
    for members in families.values():
        jobs += [(a, b, lang, float(lang == a), 1.0) for a, b in combinations(members, 2) for lang in (a, b)]
    return families, jobs


def _fitted(key: tuple, table: pa.Table) -> pa.Table:
    """Weights of one family (against all others) or pair of languages."""
    table = table.combine_chunks().sort_by([("_lang", "ascending"), ("_id", "ascending"), ("_h", "ascending")])
    x, first = sparse_of(table["feature_index"].combine_chunks(), table["feature_value"].combine_chunks()), table["y"].to_numpy() > 0.5
    how = ("hinge", 1e-4, 150) if key[1].as_py() else ("logistic", 1e-5, 200)
    weights = fit_linear(x, first.astype(float), 1 << BITS, *how, _balanced(first))
    return pa.table({"a": [key[0].as_py()], "b": [key[1].as_py()], "weights": pa.array([weights], pa.list_(pa.float64()))})


class Model:
    """Families with one linear separator each, and one per pair of languages of a family."""

    def __init__(self, families: dict[str, list[str]], weights: dict[tuple[str, str], np.ndarray]):
        self.families = families
        self.family_weights = {a: w for (a, b), w in weights.items() if not b}
        self.pairs = {k: w for k, w in weights.items() if k[1]}

    def predict(self, x: Sparse) -> tuple[list[str], np.ndarray]:
        n = len(x[0]) - 1
        names = list(self.families)
        if self.family_weights:
            margins = np.stack([dot(x, w[:-1]) + w[-1] for w in (self.family_weights[f] for f in names)])
            chance = sigmoid(margins)
            chance /= chance.sum(axis=0, keepdims=True)
        else:
            chance = np.ones((len(names), n))
        best = chance.argmax(axis=0)
        langs, score = np.empty(n, dtype=object), chance.max(axis=0)
        for k, f in enumerate(names):
            rows = np.flatnonzero(best == k)
            if len(rows):
                members, mine = self.families[f], rows_of(x, rows)
                votes, trust = np.zeros((len(members), len(rows))), np.zeros((len(members), len(rows)))
                for (i, a), (j, b) in combinations(enumerate(members), 2):
                    w = self.pairs[a, b]
                    p = sigmoid(SLOPE * (dot(mine, w[:-1]) + w[-1]))
                    votes[i] += p >= 0.5
                    votes[j] += p < 0.5
                    trust[i] += p
                    trust[j] += 1 - p
                # most votes, then the larger sum of probabilities, then the first in order
                top = (votes + trust / (len(members) + 1)).argmax(axis=0)
                langs[rows] = np.array(members, dtype=object)[top]
                if len(members) > 1:
                    score[rows] *= trust[top, np.arange(len(rows))] / (len(members) - 1)
        return langs.tolist(), np.clip(score, 0.0, 1.0)


def _balanced(positive: np.ndarray) -> np.ndarray:
    share = positive.mean() if len(positive) else 0.5
    return np.where(positive, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 1500) -> DataFrame:
    """id, held_out, lang_pred and score for every row.

    Fitted on about per_language rows of each language, or all if fewer, from rows with text and language
    whose crc32(id) mod 3 is not 1; a null id is neither held out nor learned from. Null texts and texts
    without a letter (Unicode's L, so no ½ or ②) are "und" with score 0, as is everything if nothing can be
    learned. Whole texts are read, of any length; equal texts get equal predictions. Of an id that several rows
    have in one language, one text is learned from. An empty table has no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    fold = remainder("_id", 3)
    learn = sampled(rows.where((fold != 1) & F.col("_lang").isNotNull() & F.col("_letter")), "_lang", "_id", per_language)
    how = {"char_orders": CHARS, "char_bits": BITS, "lower": True}
    model = _learned(one_text_each(learn, "_id", "_text", "_lang"), how)
    schema = rows.select("_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            texts, letter = batch.column(1), batch.column(2).to_pylist()
            langs, scores = model.predict(text_features(texts, **how)) if model else (["und"] * len(texts), np.zeros(len(texts)))
            for i in np.flatnonzero(~np.array(letter, dtype=bool)):
                langs[i], scores[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["_id", "lang_pred", "score"])

    out = rows.select("_id", "_text", "_letter").mapInArrow(run, schema)
    return out.select(F.col("_id").alias(doc_id), F.coalesce(remainder("_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def _learned(sample: DataFrame, how: dict) -> Model | None:
    spark = sample.sparkSession
    made = stage(feature_rows(sample.select("_lang", "_id", F.xxhash64("_text").alias("_h"), "_text"), "_text", **how), "features")
    families, jobs = jobs_of([r["_lang"] for r in made.select("_lang").distinct().collect()])
    if not families:
        return None
    weights: dict[tuple[str, str], np.ndarray] = {}
    if jobs:
        # one row for each model and language of it: it grows with the square of a family's languages, not with data
        wanted = spark.createDataFrame(jobs, "a string, b string, _lang string, y double, share double")
        chosen = F.pmod(F.xxhash64("_h", F.lit(31)), F.lit(1_000_003)) < F.col("share") * 1_000_003
        rows = made.join(F.broadcast(wanted), "_lang").where(chosen).repartition(len({j[:2] for j in jobs}), "a", "b")
        found = rows.select("a", "b", "_lang", "_id", "_h", "y", "feature_index", "feature_value").groupBy("a", "b").applyInArrow(_fitted, "a string, b string, weights array<double>")
        weights = {(r["a"], r["b"]): np.array(r["weights"]) for r in found.collect()}
    unstage(made)
    return Model(families, weights)
