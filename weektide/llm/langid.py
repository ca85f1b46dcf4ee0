"""Language identification by mixtures of languages.

A model holds the log probability of every hashed letter n-gram (three UTF-8 bytes,
lower case) in every language.  A word's likelihood in a language is that of its n-grams.
Expectation-maximisation finds the proportions in which the languages most likely
made a document's words.  The set of languages is chosen by penalised likelihood:
the one, two, ... languages with the largest shares compete, and a language more has
to raise the log likelihood by more than the logarithm of the number of words.

Defined results: a NULL text, or one without letters, is ``und`` with score 0 and no
proportions.  Ties go to the language that sorts first.  Equal texts get equal
results.  Training with no labelled rows gives a model without languages, which calls
everything ``und``.  Labels that are NULL are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.grams import mix, slices, utf8

#: Slots for hashed n-grams.
SLOTS = 1 << 16
#: Expected number of labelled documents per language that a model is fitted on.
TRAINED = 20_000
#: Rounds of expectation-maximisation at most, and the change at which they end.
ROUNDS, SETTLED = 40, 1e-4
_SLICE = 1 << 21
_U = np.uint64

RESULT = (
    "doc_id bigint, lang_pred string, score double, "
    "proportions array<struct<lang:string,share:double>>, fit double"
)


@dataclass(frozen=True)
class Model:
    """Languages in order of name, and ``weights[slot, language]``: log probabilities."""

    languages: list[str]
    weights: np.ndarray

    def expected(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and spread of an n-gram's log probability in each language, by the model itself."""
        weights = self.weights.astype(float)
        p = np.exp(weights)
        mean = (p * weights).sum(0)
        return mean, np.sqrt(np.maximum((p * weights * weights).sum(0) - mean * mean, 1e-12))


_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all n-grams, where each word's begin, and the text each word is in.

    A word is a run of letters: a-z, or bytes of other characters than ASCII.  Each of
    its bytes ends one n-gram of three bytes; spaces stand before the first.
    """
    raw, at = utf8(pa.array([t.lower() for t in texts], pa.large_string()))
    letter = _LETTERS[raw]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    starts = at[:-1][at[:-1] < len(raw)]
    first[starts] = letter[starts]
    spots = np.flatnonzero(letter)
    begins = np.flatnonzero(first[spots])
    place = np.arange(len(spots)) - np.repeat(begins, np.diff(begins, append=len(spots)))
    gram = raw[spots].astype(_U)
    gram |= np.where(place > 0, raw[spots - 1], 32).astype(_U) << _U(8)
    gram |= np.where(place > 1, raw[spots - 2], 32).astype(_U) << _U(16)
    owner = np.searchsorted(at, spots[begins], "right") - 1
    return (mix(gram) & _U(SLOTS - 1)).astype(np.int64), begins, owner


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(docs: DataFrame, text_col: str, lang_col: str, per_language: int = TRAINED) -> Model:
    """Fit a model on about ``per_language`` documents of each language, chosen by a
    hash of their text; with fewer than that, on all of them."""
    rows = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((SLOTS, 0), np.float32))
    rates = F.create_map(*[
        F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))
    ])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < rates[F.col("lang")] * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                slots, begins, owner = _words(part.column(0).to_pylist())
                whose = np.repeat(owner, np.diff(begins, append=len(slots)))
                langs = np.array(part.column(1).to_pylist(), object)
                for lang in set(langs):
                    chosen = slots[(langs == lang)[whose]]
                    seen = found.setdefault(lang, np.zeros(SLOTS, np.int64))
                    seen += np.bincount(chosen, minlength=SLOTS)
        for lang, seen in found.items():
            slot = np.flatnonzero(seen)
            yield pa.record_batch(
                [pa.array([lang] * len(slot)), pa.array(slot), pa.array(seen[slot])],
                ["lang", "slot", "n"],
            )

    counts = (
        rows.where(drawn).mapInArrow(count, "lang string, slot bigint, n bigint")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(sizes)
    seen = np.zeros((SLOTS, len(languages)))
    seen[counts["slot"], counts["lang"].map(languages.index)] = counts["n"]
    seen += 0.5
    return Model(languages, np.log(seen / seen.sum(0)).astype(np.float32))


def _mixture(like: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Shares of the allowed languages in every text, by expectation-maximisation.

    ``like`` holds each word's likelihoods relative to its best language; words are in
    the order of their texts.  Texts whose shares have settled leave the rounds.
    """
    shares = allowed / allowed.sum(1, keepdims=True)
    active = np.arange(len(allowed))
    begin = np.searchsorted(owner, active)
    size = np.diff(begin, append=len(owner))
    local = np.repeat(np.arange(len(active)), size)
    for turn in range(ROUNDS):
        now = shares[active]
        made = like * now[local].astype(like.dtype)
        made /= made.sum(1, keepdims=True)
        new = np.add.reduceat(made, begin, axis=0, dtype=np.float64) / size[:, None]
        shares[active] = new
        moved = np.abs(new - now).max(1) > SETTLED
        if not moved.any():
            break
        if turn % 4 == 3 and moved.mean() < 0.7:
            like = like[moved[local]]
            active, size = active[moved], size[moved]
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            local = np.repeat(np.arange(len(active)), size)
    return shares


def proportions(model: Model, texts: list[str]) -> np.ndarray:
    """Shares of the chosen languages in every text; texts without words get zeros."""
    return measured(model, texts)[0]


def measured(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shares, and how well each text fits: how many spreads an n-gram's mean log
    probability, each word taken in its best language, lies above what the text's main
    language would give.  It is NaN without words."""
    out, fit_of = np.zeros((len(texts), len(model.languages))), np.full(len(texts), np.nan)
    slots, begins, owner = _words(texts)
    if not len(begins) or not model.languages:
        return out, fit_of
    logs = np.add.reduceat(model.weights[slots], begins, axis=0)
    best = logs.max(1, keepdims=True)
    like = np.exp(np.maximum(logs - best, -60))
    docs, local = np.unique(owner, return_inverse=True)
    begin = np.searchsorted(local, np.arange(len(docs)))
    size = np.diff(begin, append=len(local))
    penalty = np.log(size + 1)

    def fit(of, words, whose, most):
        """Shares with the ``most`` largest languages allowed, and their likelihood."""
        allowed = rank[of] < most
        got = _mixture(words, whose, allowed.astype(float))
        made = np.log(np.maximum((words * got[whose]).sum(1), 1e-30))
        return got, np.bincount(whose, made, minlength=len(of))

    rank = np.zeros((len(docs), len(model.languages)), int)
    every = np.arange(len(docs))
    full, top = fit(every, like, local, len(model.languages))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    shares = (rank == 0).astype(float)
    value = np.add.reduceat(
        np.log(np.maximum((like * shares[local]).sum(1), 1e-30)), begin
    ) - penalty
    # No set of m languages is likelier than all of them together, so once that cannot
    # pay for the penalty of m, larger sets cannot win either.
    for most in range(2, len(model.languages) + 1):
        open_ = np.flatnonzero(top - most * penalty > value)
        if not len(open_):
            break
        keep = np.zeros(len(docs), bool)
        keep[open_] = True
        chosen = keep[local]
        whose = np.searchsorted(open_, local[chosen])
        got, made = fit(open_, like[chosen], whose, most)
        better = made - most * penalty[open_] > value[open_]
        shares[open_[better]] = got[better]
        value[open_[better]] = (made - most * penalty[open_])[better]
    out[docs] = shares
    mean, spread = model.expected()
    grams = np.bincount(local, np.diff(begins, append=len(slots)))
    main = shares.argmax(1)
    fit_of[docs] = (np.bincount(local, best[:, 0]) / grams - mean[main]) / spread[main]
    return out, fit_of


def identify(docs: DataFrame, id_col: str, text_col: str, model: Model) -> DataFrame:
    """Language, its share, all shares of the chosen languages, and the fit of every
    document: NULL without words, far below zero for text in no language of the model."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                texts = part.column(1).to_pylist()
                shares, fits = measured(model, [t if has_letter(t) else "" for t in texts])
                names, scores, lists = [], [], []
                for row in shares:
                    some = [(model.languages[i], row[i]) for i in np.flatnonzero(row > 0)]
                    name, score = max(some, key=lambda x: x[1], default=("und", 0.0))
                    names.append(name)
                    scores.append(min(float(score), 1.0))
                    lists.append([{"lang": k, "share": float(v)} for k, v in some])
                yield pa.record_batch(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores),
                     pa.array(lists, _SHARES), pa.array(fits, pa.float64(), from_pandas=True)],
                    ["doc_id", "lang_pred", "score", "proportions", "fit"],
                )

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(predict, RESULT)


_SHARES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
