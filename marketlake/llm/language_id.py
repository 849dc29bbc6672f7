"""Hierarchical language identification: the family first, then linear SVMs between the languages of that family."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, largest, ship, small_batches

#: Families of languages by their code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "pa"),
    "turkic": ("tr", "az", "kk", "uz"),
    "uralic": ("fi", "et", "hu"),
}
BITS = 15
SLICE = 1 << 20
#: Rows that training takes at most, in equal shares from the languages.
MAX_TRAIN_ROWS = 3200
#: Languages that are told apart, the most frequent ones: `lang` may hold noise, and each pair in a family is a model.
MAX_LANGUAGES = 64
#: Features of such a row, the largest: what the driver gathers is at most 8 bytes of these for each row.
MAX_FEATURES = 4096
_ASCII_LETTER = re.compile("[A-Za-z]")
_GRAM = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
UNKNOWN = "und"
#: Score under which a text is in none of the learned languages: texts in other scripts have 0.26 and less, the least of
#: 10,000 labelled documents 0.37.
LEAST_SCORE = 0.3
#: Training: how strongly weights are kept small, the step at which rates begin, and the value of the bias feature.
STRENGTH, START, BIAS = 1e-4, 2500, 0.1


def family_of(lang: str) -> str:
    return next((f for f, of in FAMILIES.items() if lang in of), lang)


def has_letter(text: str | None) -> bool:
    """Whether a text has a character of Unicode's letter categories: number signs and marks are none."""
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def char_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1- to 3-grams of a text's lower-cased characters; each run of ASCII digits, marks and white
    space is one space. A long text is counted in slices, with the last two characters carried on."""
    counts = np.zeros(1 << BITS, dtype=np.int64)
    carry = np.empty(0, dtype=np.uint32)
    for at in range(0, len(text), SLICE):
        c = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        c = np.where((c < 128) & ((c < 97) | (c > 122)), np.uint32(32), c)
        c = np.concatenate([carry, c])
        c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
        m = len(carry)
        carry = c[-2:]
        with np.errstate(over="ignore"):
            h = (c + np.uint32(1)) * _GRAM[0]
            for n in range(3):
                if n:
                    h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _GRAM[n] + c[n:]
                fresh = h[max(0, m - n) :]  # those that end behind what was carried on
                counts += np.bincount((fresh * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return counts


def features(text: str) -> np.ndarray:
    """Square roots of the counts, scaled to length one: long and short texts weigh the same."""
    x = np.sqrt(char_counts(text)).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


@dataclass
class Separator:
    """A linear SVM with a fitted probability that its first side is right."""

    weights: np.ndarray
    bias: float
    slope: float

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights @ x) + self.bias

    def probability(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x), -30, 30))))


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    families: dict[str, list[str]] = field(default_factory=dict)
    by_family: dict[str, Separator] = field(default_factory=dict)
    pairs: dict[tuple[str, str], Separator] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the probability of the family times the mean of the duels that the language has in it."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        x = features(text)
        shares = {f: s.probability(x) for f, s in self.by_family.items()} or {f: 1.0 for f in self.families}
        total = sum(shares.values()) or 1.0
        family = min(self.families, key=lambda f: (-shares[f], f))
        among = self.families[family]
        votes, sums = dict.fromkeys(among, 0), dict.fromkeys(among, 0.0)
        for a, b in combinations(among, 2):
            p = self.pairs[a, b].probability(x)
            votes[a if p >= 0.5 else b] += 1
            sums[a] += p
            sums[b] += 1 - p
        lang = min(among, key=lambda k: (-votes[k], -sums[k], k))
        inner = sums[lang] / (len(among) - 1) if len(among) > 1 else 1.0
        return lang, min(1.0, max(0.0, shares[family] / total * inner))


Sparse = tuple[np.ndarray, np.ndarray]


def fit_separator(first: list[Sparse], second: list[Sparse], epochs: int = 8, strength: float = STRENGTH) -> Separator:
    """Pegasos: stochastic subgradient steps on the regularised hinge loss, both sides equally often; the weights at the
    ends of the later epochs are averaged. The bias is the weight of one more feature, of value BIAS.

    Step t has the rate 1 / (strength * (t + START)). It shrinks all weights, which is done by one factor for all of
    them, and adds to those of the example.
    """
    v, scale = np.zeros((1 << BITS) + 1), 1.0
    total, taken = np.zeros_like(v), 0
    for t, (y, idx, val) in enumerate(_schedule(first, second, epochs), 1):
        rate = 1 / (strength * (t + START))
        margin = y * scale * (v[idx] @ val + v[-1] * BIAS)
        scale *= 1 - strength * rate
        if margin < 1:
            v[idx] += rate * y / scale * val
            v[-1] += rate * y / scale * BIAS
        if t % (2 * max(len(first), len(second))) == 0:  # the end of an epoch
            v, scale = v * scale, 1.0
            if 2 * t > epochs * 2 * max(len(first), len(second)):
                total += v
                taken += 1
    w, bias = total[:-1] / taken, total[-1] / taken * BIAS
    margins = np.array([y * (w[i] @ v + bias) for y, side in ((1, first), (-1, second)) for i, v in side])
    slopes = np.geomspace(0.25, 16, 49)  # one number: a search over its likelihood
    slope = slopes[np.argmin([np.logaddexp(0, -s * margins).mean() + 0.002 * s for s in slopes])]
    return Separator(w.astype(np.float32), float(bias), float(slope))


def _schedule(first: list[Sparse], second: list[Sparse], epochs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Examples (side, features, values) in the order of training: the smaller side is repeated."""
    rng = np.random.default_rng(7)
    n = max(len(first), len(second))
    for _ in range(epochs):
        order = [(1, *first[i % len(first)]) for i in rng.permutation(n)] + [(-1, *second[i % len(second)]) for i in rng.permutation(n)]
        yield from (order[j] for j in rng.permutation(2 * n))


def fit(rows: list[tuple[str, bytes, bytes]]) -> LanguageModel:
    by_lang: dict[str, list[Sparse]] = {}
    for lang, idx, val in sorted(rows):
        by_lang.setdefault(lang, []).append((np.frombuffer(idx, np.int32), np.frombuffer(val, np.float32)))
    model = LanguageModel(sorted(by_lang))
    for lang in model.languages:
        model.families.setdefault(family_of(lang), []).append(lang)
    if len(model.families) > 1:
        for f, of in sorted(model.families.items()):
            rest = [x for lang in model.languages if lang not in of for x in by_lang[lang]]
            model.by_family[f] = fit_separator([x for lang in of for x in by_lang[lang]], rest)
    for of in model.families.values():
        for a, b in combinations(of, 2):
            model.pairs[a, b] = fit_separator(by_lang[a], by_lang[b])
    return model


def train_language_model(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Learns from docs (doc_id, text, lang), a bounded sample of max_rows: equal shares for the max_languages most frequent
    languages, of each the different texts with the smallest hash. A text that many rows repeat, under one id or several,
    is one example. Executors turn the sampled texts into sparse vectors, so what the driver gathers is bounded by
    max_rows and MAX_FEATURES, however long the texts are. Rows without language or letters teach nothing."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("rank", F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 40)))
    each = known.select("lang", "rank").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in each.orderBy(F.desc("n"), "lang").limit(max(1, min(max_languages, max_rows))).collect()}
    if not sizes:
        return LanguageModel()
    share = max_rows // len(sizes)
    limit = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1 << 40, int((1 << 40) * (1.3 * share + 40) / n)))])
    drawn = known.where(F.col("rank") < limit[F.col("lang")]).dropDuplicates(["lang", "rank"]).select("lang", "rank", "text")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for lang, text, rank in zip(pdf["lang"], pdf["text"], pdf["rank"]):
                if isinstance(text, str) and has_letter(text):
                    x = features(text)
                    idx = np.flatnonzero(x).astype(np.int32)
                    idx, val = largest(idx, x[idx], MAX_FEATURES)
                    rows.append((lang, rank, idx.tobytes(), val.tobytes()))
            yield pd.DataFrame(rows, columns=["lang", "rank", "idx", "val"])

    sparse = drawn.mapInPandas(vectors, "lang string, rank bigint, idx binary, val binary")
    first = Window.partitionBy("lang").orderBy("rank", "idx", "val")  # over the drawn texts only, some max_rows
    kept = sparse.withColumn("n", F.row_number().over(first)).where(F.col("n") <= share)
    return fit([(r["lang"], bytes(r["idx"]), bytes(r["val"])) for r in kept.select("lang", "idx", "val").collect()])


def predicted(docs: DataFrame, model: LanguageModel, text: str = "text", to: str = "__language") -> DataFrame:
    """docs with a struct column `to` of lang_pred, score and has_letter, from the text alone.

    A null text, and one without letters, is `und` with score 0; so is every text if nothing was learned.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of 128 KB per pair of languages

    @F.pandas_udf("lang_pred string, score double, has_letter boolean")
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            each = [t if isinstance(t, str) else None for t in series]
            yield pd.DataFrame([(*sent.value.predict(t), has_letter(t)) for t in each], columns=["lang_pred", "score", "has_letter"])

    return docs.withColumn(to, identify(F.col(text)))


def keep_known_languages(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """docs (doc_id, text, lang and others, of any names) without null texts, texts without letters and texts that fit
    no learned language: those that the model scores under least_score, unless their lang says that it is a learned one (a
    text of a few words tells the model little). A null lang becomes the predicted one.

    If no row has a language, nothing can be learned, and every text with a letter stays. Repeated rows stay; an empty
    table gives an empty one.
    """
    model = train_language_model(docs.select("doc_id", "text", "lang"))
    to = free_name(docs, "language")
    out = predicted(docs, model, to=to)
    if not model.languages:
        return out.where(F.col(f"{to}.has_letter")).drop(to)
    fits = (F.col(f"{to}.score") >= least_score) | F.coalesce(F.col("lang").isin(model.languages), F.lit(False))
    known = out.where((F.col(f"{to}.lang_pred") != UNKNOWN) & fits)
    return known.withColumn("lang", F.coalesce("lang", F.col(f"{to}.lang_pred"))).drop(to)


def held_out(part: int, of: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == part, F.lit(False))


def identify_languages(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs (doc_id, text, lang); other columns are ignored.

    A quarter of the documents, those whose crc32(doc_id) mod 4 is 2, is held out of training. Repeated rows are
    each predicted. A null doc_id is not held out. Texts are read whole, however long, a slice at a time.
    """
    slim = docs.select("doc_id", "text", "lang")
    model = train_language_model(slim.where(~held_out(2, 4)), max_rows)
    out = predicted(slim.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(2, 4).alias("held_out"), F.col("__language.lang_pred").alias("lang_pred"), F.col("__language.score").alias("score"))
