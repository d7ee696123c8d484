"""Language identification as multilingual mixture inference.

Each language has a distribution over hashed byte trigrams of words (with word boundaries), counted over all
labelled training rows. A document is a mixture: each word is of one of the languages, in proportions that
expectation-maximisation estimates from the words' likelihoods. Languages leave the set, least share first, as
long as the likelihood they explain is worth less than a penalty (a multiple of the log of the word count).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, map_text, pieces

_LETTER = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if 0x61 <= _c <= 0x7A or _c >= 0x80:
        _LETTER[_c] = _c
    elif 0x41 <= _c <= 0x5A:
        _LETTER[_c] = _c + 32


def trigrams(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, word, doc): the hashed trigrams whose middle byte is in a word, each word's first gram, each word's text."""
    raw = np.frombuffer(b"".join(x for t in texts for x in (b" ", t, b" ")), np.uint8)
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    low = _LETTER[raw]
    inside = low != 0x20
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    # the blank before a word is kept as the one after the word before it, or a new one at a text's start
    keep[np.cumsum(sizes) - sizes] = True
    buffer = low[keep]
    owner = np.repeat(np.arange(len(texts)), sizes)[keep]
    if len(buffer) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    middle = buffer[1:-1] != 0x20
    wide = buffer.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    gram = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)[middle]
    at = np.flatnonzero(middle)
    first = np.flatnonzero(buffer[at] == 0x20)  # the trigram that starts with the blank before a word
    return gram, first, owner[at + 1][first]


@dataclass(frozen=True)
class Model:
    langs: list[str]
    logp: np.ndarray  # (grams, languages)
    bits: int


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", bits: int = 16, smooth: float = 0.5, most_bytes: int = 256 << 20) -> Model:
    """Trigram counts of every row whose `lang` is not null. Null texts add nothing; no rows give a model without languages.

    Repeated rows count as often as they repeat. The table has (languages x 2^bits) cells and is sent to the executors;
    ValueError if it would pass `most_bytes` as floats (about 1,000 languages at 16 bits): the caller then chooses fewer
    bits. An empty table gives a model without languages.
    """
    rows = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"))
    n_langs = rows.select("l").distinct().count()
    if n_langs * 4 << bits > most_bytes:
        raise ValueError(f"{n_langs} languages x 2^{bits} grams pass {most_bytes} bytes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in pieces(batches, 0, 1 << 21):
            texts, names = Texts(part.column(0)), part.column(1).to_pylist()
            gram, first, doc = trigrams([texts.bytes(i) for i in range(texts.n)], bits)
            own = sorted(set(names))
            index = np.array([own.index(x) for x in names])
            if len(gram):
                label = np.repeat(index[doc], np.diff(np.append(first, len(gram))))
                got = np.bincount((label << bits) | gram, minlength=len(own) << bits).reshape(len(own), -1)
                for k, x in enumerate(own):
                    total[x] = total[x] + got[k] if x in total else got[k]
        for x, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at), pa.array(c[at])], ["l", "g", "c"])

    # a partial count a task and gram before the shuffle; at most languages x 2^bits rows come back
    cells = rows.mapInArrow(count, "l string, g long, c long").groupBy("l", "g").agg(F.sum("c").alias("c")).toPandas()
    langs = sorted(cells.l.unique())
    counts = np.zeros((1 << bits, len(langs)))
    counts[cells.g.to_numpy(int), cells.l.map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = cells.c.to_numpy(float)
    logp = np.log((counts + smooth) / (counts.sum(0) + smooth * (1 << bits))).astype(np.float32)
    return Model(langs, logp, bits)


def infer(model: Model, texts: list[bytes], *, penalty: float = 2.0, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(shares, words): each text's language proportions, zero outside the chosen set, and its number of words."""
    n, k = len(texts), len(model.langs)
    shares, words = np.zeros((n, k)), np.zeros(n, np.int64)
    gram, first, doc = trigrams(texts, model.bits)
    if not len(first) or not k:
        return shares, words
    logs = np.add.reduceat(model.logp[gram], first)  # (words, languages)
    like = np.exp(logs - logs.max(1, keepdims=True)).astype(np.float32)
    words = np.bincount(doc, minlength=n)
    have = np.flatnonzero(words)
    start = np.cumsum(words[have]) - words[have]
    size = words[have]
    pi = np.full((len(have), k), 1 / k, np.float32)

    def em(pi: np.ndarray, times: int, like: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(times):
            part = like * np.repeat(pi, size, 0)
            part /= np.maximum(part.sum(1, keepdims=True), 1e-30)
            pi = np.add.reduceat(part, start) / size[:, None]
        fit = np.log(np.maximum((like * np.repeat(pi, size, 0)).sum(1), 1e-30, dtype=np.float64))
        return pi, np.add.reduceat(fit, start)

    pi, fit = em(pi, rounds, like, start, size)
    active = np.arange(len(have))
    for _ in range(k - 1):
        # leave out the language of the least share, where that costs less than the penalty
        live = np.where(pi[active] > 0, pi[active], np.inf)
        several = (live < np.inf).sum(1) > 1
        active, live = active[several], live[several]
        if not len(active):
            break
        trial = pi[active].copy()
        trial[np.arange(len(active)), k - 1 - live[:, ::-1].argmin(1)] = 0  # of equal ones the last in order
        trial /= trial.sum(1, keepdims=True)
        sub = like if len(active) == len(have) else like[np.repeat(np.isin(np.arange(len(have)), active), size)]
        own = size[active]
        trial, got = em(trial, 4, sub, np.cumsum(own) - own, own)
        better = got >= fit[active] - penalty * np.log1p(own)
        pi[active[better]], fit[active[better]] = trial[better], got[better]
        active = active[better]
    shares[have] = pi
    return shares, words


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, penalty: float = 2.0) -> DataFrame:
    """Adds lang_pred, score (its share), langs and shares (the chosen set, largest share first).

    lang_pred is 'und' and score 0 where the text is null or has no letter, or the model no language; equal
    shares go to the language first in code-point order. Repeated rows get the same result; columns of the results' names
    are replaced. An empty table gives an empty result. A text is read as a whole, with a few numbers for each of its
    bytes and languages: memory is bounded by the longest text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def of(texts: Texts) -> list[pa.Array]:
            raw = [texts.bytes(i) for i in range(texts.n)]
            shares, words = infer(m, raw, penalty=penalty)
            pred, score, names, parts = [], [], [], []
            for i in range(texts.n):
                if not words[i] or not len(m.langs) or not has_letter(raw[i]):
                    pred.append("und"), score.append(0.0), names.append([]), parts.append([])
                    continue
                order = [j for j in np.argsort(-shares[i], kind="stable") if shares[i, j] > 0]
                pred.append(m.langs[order[0]])
                score.append(float(min(1.0, shares[i, order[0]])))
                names.append([m.langs[j] for j in order])
                parts.append([float(shares[i, j]) for j in order])
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(names, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))]

        return of

    return map_text(docs, text, make, [("lang_pred", "string"), ("score", "double"), ("langs", "array<string>"), ("shares", "array<double>")], keep=keep, most_bytes=1 << 20)
