"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a fixed lexicon and of one learned from the training rows (two tiers by log
odds), how near lexicon words stand to second-person words, capitals, punctuation, and obfuscation (letters
replaced by look-alikes, stretched letters). Trees are grown on binned features with the logistic loss on a
bounded sample of labelled rows; a held-back part of it calibrates the margin by isotonic regression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, map_text, pieces

LEXICON = frozenset(b"idiot idiots stupid moron morons loser losers clown clowns trash scum worthless dumb pathetic garbage fool fools disgusting ugly hate hated vermin".split())
SECOND = frozenset(b"you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine sie ihr euch usted ustedes ti tus vosotros".split())
_CLEAN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 or c == 0x27 else 0x20 for c in range(256))
_LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")
_LEET_CLEAN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 or chr(c) in "013457@$!|*" else 0x20 for c in range(256))
_UPPER = bytes(range(0x41, 0x5B))
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MIXED = re.compile(rb"(?<![0-9A-Za-z@$!|])[A-Za-z]*[A-Za-z][0-9@$!|]{1,3}[A-Za-z][0-9A-Za-z@$!|]*")
_STRETCH = re.compile(rb"([A-Za-z])\1\1\1*")
_CAPS = re.compile(rb"\b[A-Z]{3,}\b")
_SPACED = re.compile(rb"\b(?:[A-Za-z][.\-* ]){3,}[A-Za-z]\b")
NAMES = ("log_words", "fixed", "strong", "weak", "n_fixed", "n_strong", "n_kinds", "near_you", "nearest_you", "you", "capitals", "caps_words", "exclaim", "question", "punct", "mixed", "stretched", "hidden", "n_hidden", "digits")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def features(text: bytes, strong: frozenset, weak: frozenset) -> list[float]:
    """The values of NAMES; an empty text has zeros."""
    n = max(1, len(text))
    words = words_of(text)
    m = max(1, len(words))
    kinds = set(words)
    fixed, deep, light = kinds & LEXICON, kinds & strong, kinds & weak
    n_fixed = n_deep = n_light = near = 0
    nearest = 50
    you = [i for i, w in enumerate(words) if w in SECOND] if kinds & SECOND else []
    if fixed or deep or light:
        spots = []
        for i, w in enumerate(words):
            hit = w in fixed
            n_fixed += hit
            if w in deep:
                n_deep += 1
                hit = True
            elif w in light:
                n_light += 1
            if hit:
                spots.append(i)
        if you and spots:
            gap = np.abs(np.array(spots)[:, None] - np.array(you)[np.clip(np.searchsorted(you, spots)[:, None] + np.array([-1, 0]), 0, len(you) - 1)]).min(1)
            near, nearest = int((gap <= 5).sum()), min(50, int(gap.min()))
    mixed = _MIXED.findall(text)
    hidden = 0
    if mixed or _SPACED.search(text):
        known = LEXICON | strong
        plain = [w for x in mixed for w in x.translate(_LEET).translate(_CLEAN).split()]
        plain += [re.sub(rb"[^a-z]", b"", x.lower()) for x in _SPACED.findall(text)]
        hidden = sum(w in known for w in plain)
    upper = len(text) - len(text.translate(None, _UPPER))
    return [
        float(np.log1p(len(words))), n_fixed / m, n_deep / m, n_light / m, float(n_fixed), float(n_deep), float(len(fixed | deep)), near / m, float(nearest), len(you) / m,
        upper / n, len(_CAPS.findall(text)) / m, text.count(b"!") / n, text.count(b"?") / n, (len(text) - len(text.translate(None, _PUNCT))) / n, len(mixed) / m, len(_STRETCH.findall(text)) / m,
        hidden / m, float(hidden), (len(text) - len(text.translate(None, b"0123456789"))) / n,
    ]


@dataclass
class Trees:
    """Boosted trees of fixed depth on binned features; margins are log odds."""

    edges: list[np.ndarray]
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # split feature, split bin, leaf values
    depth: int

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 5.0) -> "Trees":
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        code = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
        p0 = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        out = cls(edges, float(np.log(p0 / (1 - p0))), [], depth)
        margin = np.full(len(y), out.base)
        d = x.shape[1]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(2**depth - 1, int), np.full(2**depth - 1, bins + 1)
            node = np.zeros(len(y), int)
            for level in range(depth):
                width = 2**level
                flat = (node[:, None] * d + np.arange(d)) * (bins + 1) + code
                gs = np.bincount(flat.ravel(), np.repeat(g, d), width * d * (bins + 1)).reshape(width, d, -1)
                hs = np.bincount(flat.ravel(), np.repeat(h, d), width * d * (bins + 1)).reshape(width, d, -1)
                gl, hl = gs.cumsum(2), hs.cumsum(2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                best = gain.reshape(width, -1).argmax(1)
                f, b = best // (bins + 1), best % (bins + 1)
                feature[width - 1 : 2 * width - 1], cut[width - 1 : 2 * width - 1] = f, b
                node = node * 2 + (code[np.arange(len(y)), f[node]] > b[node])
            gsum, hsum = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
            leaf = rate * gsum / (hsum + ridge)
            out.trees.append((feature, cut, leaf))
            margin += leaf[node]
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        code = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], 1)
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), int)
            for level in range(self.depth):
                at = node + 2**level - 1
                node = node * 2 + (code[rows, feature[at]] > cut[at])
            total += leaf[node]
        return total


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: increasing step values of y over x, as points (mean x, mean y) to interpolate."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            c = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], c, strict=True)]
    return np.array([a / n for a, _, n in blocks]), np.array([b / n for _, b, n in blocks])


@dataclass
class Model:
    strong: frozenset
    weak: frozenset
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(x))
        return np.clip(np.interp(self.trees.margin(x), *self.points), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 20_000, most_words: int = 500, odds: float = 2.0, seed: int = 17) -> Model:
    """Fit on at most `sample` labelled rows (by id hash) of `labels`; null labels and ids are left out.

    An id labelled more than once counts as toxic if any of its labels is. Rows that share an id are all used.
    Without both classes in the sample, the model scores 0 everywhere.
    """
    ids = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("i")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
    chosen = ids.orderBy(F.xxhash64(F.lit(seed), "i"), "i").limit(sample)
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).join(F.broadcast(chosen), "i").select("t", "y", F.pmod(F.xxhash64(F.lit(seed + 1), "i"), F.lit(10)).cast("int").alias("f"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for part in pieces(batches, 0, 1 << 21):
            texts, y, f = Texts(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist()
            for i in range(texts.n):
                if f[i] < 7:
                    seen[y[i] > 0].update(set(words_of(texts.bytes(i))))
        words = sorted(set(seen[0]) | set(seen[1]))
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([seen[0][w] for w in words], pa.int64()), pa.array([seen[1][w] for w in words], pa.int64())], ["w", "n0", "n1"])

    base = rows.where("f < 7").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("n1")).first()
    if not base.n1 or base.n1 == base.n:
        return Model(frozenset(), frozenset(), None, (np.zeros(1), np.zeros(1)))
    # how much likelier a word is in a toxic document, with add-one counts
    rate = F.log((F.col("n1") + 0.5) / (base.n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (base.n - base.n1 + 1.0))
    found = rows.mapInArrow(count, "w binary, n0 long, n1 long").groupBy("w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n1 >= 5").withColumn("odds", rate).where(F.col("odds") >= odds / 2).orderBy(F.desc("odds"), "w").limit(most_words).collect()
    strong = frozenset(bytes(r.w) for r in found if r.odds >= odds)
    weak = frozenset(bytes(r.w) for r in found if r.odds < odds)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 0, 1 << 21):
            texts = Texts(part.column(0))
            x = [features(texts.bytes(i), strong, weak) for i in range(texts.n)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), part.column(1), part.column(2)], ["x", "y", "f"])

    got = rows.mapInArrow(extract, "x array<double>, y int, f int").toPandas()  # `sample` rows of some twenty numbers
    x, y, f = np.stack(got.x.to_numpy()), (got.y.to_numpy() > 0).astype(float), got.f.to_numpy()
    order = np.lexsort((*x.T, y))
    x, y, f = x[order], y[order], f[order]
    fit = f < 7
    trees = Trees.fit(x[fit], y[fit])
    held = ~fit if (~fit).any() and 0 < y[~fit].sum() < (~fit).sum() else fit
    return Model(strong, weak, trees, isotonic(trees.margin(x[held]), y[held]))


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, at: float = 0.7) -> DataFrame:
    """Adds score (0 to 1, higher: likelier toxic) and predicted (1 from `at` on).

    Null and empty texts are scored as empty, equal texts alike, so repeated rows get the same result. Columns of `docs`
    named score or predicted are replaced. An empty table gives an empty result. A text is read as a whole: memory is
    a few times that of the longest one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def of(texts: Texts) -> list[pa.Array]:
            x = np.array([features(texts.bytes(i), m.strong, m.weak) for i in range(texts.n)])
            s = m.score(x)
            return [pa.array(s, pa.float64()), pa.array((s >= at).astype(np.int32), pa.int32())]

        return of

    return map_text(docs, text, make, [("score", "double"), ("predicted", "int")], keep=keep)
