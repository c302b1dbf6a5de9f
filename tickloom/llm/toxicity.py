"""Toxicity by weak supervision.

Voters are lexicons and patterns: a small fixed word list, lexicons and word-stem patterns mined from
labelled texts of the learning folds, and marks of style. They vote on a bounded sample of all documents of the
learning folds, most of them without a label. A generative label model with one hidden class estimates every
voter's accuracy on that sample by expectation-maximisation, and the voters' correlations within a class, by
which agreeing copies of one signal are counted as one. Given labels are one more voter, a sparse one: they tell
which of the two classes is the toxic one, and their own accuracy is estimated with the others'. The posterior
class probabilities then train the linear classifier that scores texts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import remainder, stage
from tickloom.llm.features import dot, fit_linear, one_text_each, sampled, sigmoid, word_hashes
from tickloom.llm.tokens import in_slices, words_of

#: Insults in several languages: the fixed lexicon.
INSULTS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb fool imbecile jerk bastard "
    "dummkopf arschloch depp trottel abschaum connard imbécile salaud ordure crétin idiota estúpido imbécil basura cabrón"
).split()
LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (3, 4, 5, 6, 7)
LEXICONS, PATTERNS = 16, 16
#: What a row without a label weighs in the estimates, against one with a label.
UNLABELLED = 0.25
#: What is known of the labels' accuracy before they are seen: right and wrong labels that count along.
PRIOR = (19.0, 1.0)
#: Sketches by which near copies among the labelled texts are made one.
COPIES = 4


def tokens_of(words: list[str]) -> list[list[str]]:
    """For each lower-case word, its letter runs, and their stems marked with a trailing star."""
    out = []
    for word in words:
        found = []
        for run in LETTERS.findall(word):
            found.append(run)
            found += [run[:n] + "*" for n in STEMS if len(run) > n]
        out.append(found)
    return out


def distinct_tokens(texts: pa.Array) -> list[set[str]]:
    """Of each text."""
    words, counts = words_of(texts)
    coded = words.dictionary_encode() if len(words) else None
    names = tokens_of([w.lower() for w in coded.dictionary.to_pylist()]) if coded is not None else []
    codes, at, out = coded.indices.to_numpy() if coded is not None else np.zeros(0, dtype=np.int32), 0, []
    for n in counts.tolist():
        out.append({t for c in np.unique(codes[at : at + n]).tolist() for t in names[c]})
        at += n
    return out


def sketches(texts: pa.Array) -> np.ndarray:
    """COPIES minima of differently mixed hashes of each text's word triples: near copies share most of them.

    A text without a triple has a hash of itself.
    """
    words, counts = words_of(texts)
    h = word_hashes(words, 62).astype(np.uint64)
    out, at = np.zeros((len(counts), COPIES), dtype=np.int64), 0
    plain = texts.to_pylist()
    for i, n in enumerate(counts.tolist()):
        if n >= 3:
            own = h[at : at + n]
            triple = own[:-2] * np.uint64(0x9E3779B97F4A7C15) + own[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + own[2:]
            for k in range(COPIES):
                mixed = (triple ^ np.uint64(0xA0761D6478BD642F * (k + 1) % 2**64)) * np.uint64(0xE7037ED1A0B428DB)
                out[i, k] = (mixed ^ (mixed >> np.uint64(32))).min() >> np.uint64(1)
        else:
            out[i] = int.from_bytes(hashlib.blake2b((plain[i] or "").encode(), digest_size=7).digest(), "big")
        at += n
    return out


def style_votes(text: str) -> tuple[bool, bool]:
    """Mostly capitals; many exclamation marks. Both are counted over the whole text."""
    letters = sum(map(str.isalpha, text))
    return sum(map(str.isupper, text)) * 2 > letters > 20, text.count("!") * 20 > len(text) > 0


class Voters:
    """The mined entries, the strongest first, in numbered lexicons (whole words) and patterns (stems) of entries of
    like strength: a voter's accuracy is that of its entries."""

    def __init__(self, entries: list[str]):
        self.entries = {e: i for i, e in enumerate(entries)}
        fixed = set(INSULTS)
        voter, seen, total = [], {True: 0, False: 0}, {s: sum(e.endswith("*") == s for e in entries) for s in (True, False)}
        for e in entries:
            stem = e.endswith("*")
            voter.append(1 + (LEXICONS + seen[stem] * PATTERNS // total[stem] if stem else seen[stem] * LEXICONS // total[stem]))
            seen[stem] += 1
        self.voter = np.array(voter, dtype=np.int64)
        self.fixed = fixed
        self.count = 1 + LEXICONS + PATTERNS + 2

    def votes(self, hits: list[int], insult: bool, style: tuple[bool, bool]) -> np.ndarray:
        out = np.zeros(self.count, dtype=bool)
        out[0] = insult
        out[self.voter[hits]] = True
        out[-2:] = style
        return out


def first_guess(votes: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Where expectation-maximisation starts: labelled rows at their labels, the others where voters put them whose
    rates are those of the labelled rows; without labels, where at least one voter fires."""
    known, v = ~np.isnan(given), votes.astype(float)
    if known.any():
        y = given[known] == 1
        rate = [(v[known][y == c].sum(axis=0) + 0.5) / ((y == c).sum() + 1.0) for c in (False, True)]
        logit = v @ np.log(rate[1] / rate[0]) + (1 - v) @ np.log((1 - rate[1]) / (1 - rate[0]))
        q = sigmoid(logit)
    else:
        q = v.any(axis=1).astype(float)
    return np.where(known, np.nan_to_num(given), q) * 0.98 + 0.01


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior probability of the toxic class for each row, and the estimated parameters.

    votes: rows by voters, 0 or 1. given: a label 0 or 1, or NaN where there is none. A label is a voter too,
    which mostly abstains and is right equally often in both classes; how often is estimated with the others', from
    PRIOR on, and nothing holds it up but that it is at least a half: that labels are right more often than wrong says
    which class is which. So labels that most voters speak against are overruled. A vote's log-likelihood ratio is divided by
    its total correlation, taken within the class, with the voters that vote alike in the row, so that repetitions of
    one signal add up to one vote; voters without any correlation above 0.1 make it plain expectation-maximisation.
    """
    known = ~np.isnan(given)
    q, v = first_guess(votes, given), votes.astype(float)
    for turn in range(rounds):
        mass = np.stack([1 - q, q]) * np.where(known, 1.0, UNLABELLED)
        total = mass.sum(axis=1) + 2.0
        rate = (mass @ v + 1.0) / total[:, None]
        right = sum((mass[c][known] * (given[known] == c)).sum() for c in (0, 1))
        accuracy = max(0.5, (right + PRIOR[0]) / (mass[:, known].sum() + sum(PRIOR)))
        apart = [v - rate[c] for c in (0, 1)]
        together = sum((apart[c] * mass[c][:, None]).T @ apart[c] for c in (0, 1))
        spread = np.sqrt(np.diag(together)) + 1e-9
        correlation = np.abs(together / spread[:, None] / spread)
        np.fill_diagonal(correlation, 1.0)
        # until voters have parted the classes, wrong labels would pass for correlation
        copies = np.where(correlation > 0.1, correlation, 0) if turn >= rounds // 3 else np.eye(len(correlation))
        prior = np.log(total[1] / total[0])
        ratio = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
        logit = prior + (v / np.maximum(v @ copies, 1) * ratio[0]).sum(axis=1) + ((1 - v) / np.maximum((1 - v) @ copies, 1) * ratio[1]).sum(axis=1)
        said = np.where(given == 1, 1.0, -1.0) * math.log(accuracy / (1 - accuracy))
        q = sigmoid(logit + np.where(known, said, 0.0))
    return q, {"rate": rate, "correlation": correlation, "share": 1.0 / copies.sum(axis=1), "accuracy": accuracy}


class Model:
    """A linear classifier over the entries found in a text, whether any was found, and the voters."""

    def __init__(self, voters: Voters, rows: list[tuple[list[int], bool, tuple[bool, bool]]], given: np.ndarray):
        self.voters, self.width = voters, len(voters.entries)
        votes = np.stack([voters.votes(*r) for r in rows])
        posterior, self.parameters = label_model(votes, given)
        self.weights = fit_linear(self.features(rows), posterior, self.width + 1 + voters.count, "logistic", 1e-5, 1500)

    def features(self, rows: list) -> tuple:
        indptr, index = [0], []
        for hits, insult, style in rows:
            votes = self.voters.votes(hits, insult, style)
            mine = [*hits, *([self.width] if insult or hits else []), *(self.width + 1 + np.flatnonzero(votes)).tolist()]
            index += mine
            indptr.append(len(index))
        return np.array(indptr, dtype=np.int64), np.array(index, dtype=np.int32), np.ones(len(index), dtype=np.float32)

    def score(self, rows: list) -> np.ndarray:
        return sigmoid(dot(self.features(rows), self.weights[:-1]) + self.weights[-1]) if rows else np.zeros(0)

    def rows_of(self, texts: pa.Array) -> list[tuple[list[int], bool, tuple[bool, bool]]]:
        """What the classifier sees of each text; a word's entries are looked up once per batch."""
        words, counts = words_of(texts)
        plain, out, at = texts.to_pylist(), [], 0
        if len(words):
            coded = words.dictionary_encode()
            names = tokens_of([w.lower() for w in coded.dictionary.to_pylist()])
            found = [[self.voters.entries[t] for t in some if t in self.voters.entries] for some in names]
            insult = np.array([any(t in self.voters.fixed for t in some) for some in names])
            useful = np.array([bool(f) for f in found]) | insult
            codes = coded.indices.to_numpy()
            hot = useful[codes]
        for t, n in zip(plain, counts.tolist()):
            mine = np.unique(codes[at : at + n][hot[at : at + n]]).tolist() if n else []
            out.append((sorted({e for c in mine for e in found[c]}), any(insult[c] for c in mine), style_votes(t or "")))
            at += n
        return out


def mined(tokens: DataFrame, totals: dict[int, int]) -> list[str]:
    """Tokens that speak for the toxic class far beyond chance, the strongest first.

    tokens: one row per (token, class) occurrence in a distinct text of the labelled sample, which bounds them.
    Chance is judged against the number of tokens tried, so the bar rises with the vocabulary.
    """
    counts = tokens.groupBy("token").agg(F.count_if(F.col("_y") == 1).alias("p"), F.count_if(F.col("_y") == 0).alias("n"))
    counts = stage(counts.where("p >= 4"), "tokens")
    tried = counts.count()
    a, b = float(totals.get(1, 0) + 1), float(totals.get(0, 0) + 1)
    share, expected = F.col("p") / (F.col("p") + F.col("n")), a / (a + b)
    # log likelihood ratio of a share this large against the classes' own shares
    g = F.col("p") * F.log(share / expected) + F.when(F.col("n") > 0, F.col("n") * F.log((1 - share) / (1 - expected))).otherwise(0.0)
    strength = F.log((F.col("p") + 0.5) / a * b / (F.col("n") + 0.5))
    good = counts.withColumn("g", g).where((strength > 3.0) & (share > expected) & (F.col("g") > F.lit(float(np.log(max(tried, 1)) + 2.3))))
    return [r["token"] for r in good.orderBy(F.col("g").desc(), "token").collect()]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int, unlabelled: int) -> Model | None:
    """A model from about per_class labelled texts of each class and unlabelled others, all of the learning folds."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).where("_id is not null and _y is not null")
    known = known.where(remainder("_id", 3) != 1).groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
    known = sampled(known, "_y", "_id", per_class)
    # at most about 2 * per_class ids, whatever the size of labels
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where("_text is not null")
    rows = one_text_each(texts.join(F.broadcast(known), "_id"), "_id", "_text", "_y").select("_id", "_y", "_text")
    # the same share of all texts, by a hash of the text, so that copies are one
    others = texts.where(remainder("_id", 3) != 1)
    share = min(1.0, unlabelled / max(1, others.count()))
    others = others.withColumn("_h", F.xxhash64("_text", F.lit(29))).where(F.pmod("_h", F.lit(1_000_003)) < math.floor(share * 1_000_003))
    others = others.groupBy("_h").agg(F.min("_id").alias("_id"), F.min("_text").alias("_text"))
    rows = rows.union(others.select("_id", F.lit(None).cast("int"), "_text"))
    names = [f"_s{k}" for k in range(COPIES)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            found = sketches(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(found[:, k]) for k in range(COPIES)]], names=["_id", "_y", "_text", *names])

    # near copies are one example, labelled if one of them is: what a word says of a class must come from different texts
    rows = stage(rows.select("_id", "_y", "_text").mapInArrow(sketch, rows.select("_id", "_y", "_text", *[F.lit(0).cast("long").alias(n) for n in names]).schema), "labelled")
    kept = rows.drop("_text")
    for n in names:
        kept = kept.groupBy(n).agg(F.min_by(F.struct(*kept.columns), F.struct(F.col("_y").isNull(), "_id", "_y")).alias("_row")).select("_row.*")
    ours = kept.select("_id", F.col("_y").alias("_k")).distinct()
    rows = stage(rows.join(F.broadcast(ours), (rows["_id"] == ours["_id"]) & rows["_y"].eqNullSafe(ours["_k"]), "left_semi").select("_id", "_y", "_text"), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 128):
            found = [sorted(s) for s in distinct_tokens(batch.column(1))]
            ys = batch.column(0)
            yield pa.RecordBatch.from_arrays([ys, pa.array(found, pa.list_(pa.string()))], names=["_y", "tokens"])

    marked = rows.where("_y is not null")
    totals = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    entries = mined(marked.select("_y", "_text").mapInArrow(run, "_y int, tokens array<string>").select("_y", F.explode("tokens").alias("token")), totals)
    voters = Voters(entries)
    reader = Model.__new__(Model)
    reader.voters, reader.width = voters, len(entries)

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            seen = reader.rows_of(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in seen], pa.list_(pa.int32())), pa.array([r[1] for r in seen]), pa.array([r[2][0] for r in seen]), pa.array([r[2][1] for r in seen])],
                names=["_id", "_y", "hits", "insult", "capitals", "marks"],
            )

    seen = rows.mapInArrow(see, rows.select("_id", "_y", F.array().cast("array<int>").alias("hits"), F.lit(True).alias("insult"), F.lit(True).alias("capitals"), F.lit(True).alias("marks")).schema)
    sample = seen.toArrow().combine_chunks().sort_by([("_id", "ascending"), ("_y", "ascending")]).to_pylist()
    given = np.array([np.nan if r["_y"] is None else r["_y"] for r in sample], dtype=float)
    return Model(voters, [(r["hits"], r["insult"], (r["capitals"], r["marks"])) for r in sample], given)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = 6000, unlabelled: int = 12_000, score: str = "score") -> DataFrame:
    """docs with a double column score (0 to 1) after all others; a column of that name is replaced.

    Learned from rows whose crc32(id) mod 3 is not 1: about per_class labelled texts of each class and unlabelled
    others, a bounded sample of all documents; a null id is not learned from. Labels of one id are averaged, and of
    an id that several rows have, one text is learned from. Texts of any length are read whole. Null and empty texts are scored as texts in which nothing is found; without labels of both classes only
    the fixed lexicon speaks. Equal texts have equal scores; other columns go through untouched.
    """
    model = fit(docs, labels, doc_id, text, label, per_class, unlabelled)
    rest = [c for c in docs.columns if c != score]
    at = rest.index(text)
    if model is None:
        plain = F.lower(F.coalesce(F.col(text), F.lit("")))
        return docs.select(*rest, F.when(plain.rlike(rf"(?<!\p{{L}})({'|'.join(INSULTS)})(?!\p{{L}})"), 0.9).otherwise(0.1).alias(score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(model.rows_of(batch.column(at))), pa.float64())], names=[*rest, score])

    return docs.select(*rest).mapInArrow(run, docs.select(*rest, F.lit(0.0).alias(score)).schema)
