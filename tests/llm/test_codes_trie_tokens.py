"""Vector codes, the prefix trie and token counts against plain Python; nulls, ties, repeats, empty tables, clashes, long texts."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from genespark.llm import codebooks, prefixtrie, tokencount
from genespark.llm.util import crc_mod

VECTORS = "vec_id long, embedding array<double>, label string, error string, v string"


def plain_codes(rows, entries, rounds, parts=4, scale=1024):
    """Rows (id, vector, label) through plain Lloyd rounds over all pairs: codes, errors, label errors, digest."""
    kept = [(i, [max(-(2**40), min(2**40, math.floor(max(-1e300, min(1e300, x * scale))))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([parts, *(-(-len(v) // parts) * parts for _, v, _ in kept)])
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = width // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min((far(cut(v, p), c), j) for j, c in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), g in zip(kept, got, strict=True) if g[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    got = assign()
    errors = [min(sum(x for x, _ in g), 2**63 - 1) for g in got]
    by = defaultdict(int)
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i is None, i), "".join(f"{j:02x}" for _, j in g), e, min(by[lab], 2**63 - 1), digest) for (i, _, lab), g, e in zip(kept, got, errors, strict=True))


def found_codes(spark, rows, entries, rounds):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    out = codebooks.compress(df, entries=entries, rounds=rounds, block_rows=7)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(((r.vec_id is None, r.vec_id), *r[1:]) for r in out.collect())


def test_codes_against_all_pairs(spark):
    r = random.Random(3)
    near = [[r.randint(-3, 3) / 8 for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + r.choice([0, 0, 0, 1 / 1024, -0.001]) for x in r.choice(near)], r.choice(["a", "a", "b", None])) for i in range(300)]
    assert found_codes(spark, rows, 16, 4) == plain_codes(rows, 16, 4)


def test_codes_of_odd_rows(spark):
    one = [0.25, 0.5, -0.5, 0.0, 0.125]  # five components: padded to eight
    rows = [(3, one, None), (3, one, None), (3, [0.0] * 5, "a"), (None, one, "a"), (1, None, "a"), (2, [1.0, None], "a"), (4, [float("nan")], "b"), (5, [float("inf")], "b"), (6, [], "b"), (7, [-0.0001], ""), (8, [2.0**50, -1e300], "big"), (9, [3e5, 1.0], "big"), (10, [1e308] * 5, "big")]
    assert found_codes(spark, rows, 4, 3) == plain_codes(rows, 4, 3)
    assert found_codes(spark, rows[:2], 256, 2) == plain_codes(rows[:2], 256, 2)  # equal entries: the lower index
    assert found_codes(spark, [], 4, 2) == [] == found_codes(spark, rows[4:6], 4, 2)


def test_bounds_scan_little_and_change_nothing():
    """After small moves, codes from kept bounds are those of a full scan, and most parts are not scanned."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-1000, 1000, (2, 20, 3))
    v = np.stack([centres[p, rng.integers(0, 20, 4000)] + rng.integers(-40, 40, (4000, 3)) for p in range(2)], 1)
    books = codebooks.Books.of(centres)
    code, upper, lower = np.zeros((4000, 2), np.int64), np.full((4000, 2), np.inf), np.zeros((4000, 2))
    books.assign(v, code, upper, lower)
    for _ in range(4):
        moved = books.entries + rng.integers(-6, 7, books.entries.shape)
        books = codebooks.Books.of(moved, books.entries)
        scanned = books.assign(v, code, upper, lower)
        assert (code == np.stack([codebooks.squares(v[:, p], moved[p]).argmin(1) for p in range(2)], 1)).all()
        assert scanned < 2000


def plain_trie(rows, heads=lambda c: zlib.crc32(str(c).encode()) % 6, base=lambda c: c - int(math.fmod(c, 100))):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            said[c].append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    own = {c: [x for _, x in sorted(t, key=lambda z: z[0])] for c, t in said.items()}
    whole = {c: own.get(base(c), [])[: heads(c)] + t[heads(c) :] for c, t in own.items()}
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for node, ids in members.items():
        under = [x for x in members if x[: len(node)] == node]
        leaf = lambda x: not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)
        ends = ",".join(map(str, sorted(c for c in ids if len(whole[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), sum(len(x) == len(node) + 1 for x in under), sum(map(leaf, under)), sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_trie(spark, rows, rebuilt=True):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, digest string, depth int")
    turns = prefixtrie.turns(df)
    c = F.col("c")
    steps = prefixtrie.shared_heads(turns, crc_mod("c", 6), c - c % 100, 5) if rebuilt else prefixtrie.as_they_are(turns)
    return sorted((tuple(r) for r in prefixtrie.trie(steps).drop("digest").collect()), key=repr)


def test_trie_against_all_prefixes(spark):
    r = random.Random(8)
    rows = [(c, t, "user" if t % 2 else "assistant", r.choice(["a", "bb", "é😀", "", "c d"])) for c in [*range(60), *range(100, 130), *range(-5, 0), -100, 250] for t in range(r.choice([1, 2, 3, 7]))]
    r.shuffle(rows)
    assert found_trie(spark, rows) == plain_trie(rows)
    assert found_trie(spark, rows, rebuilt=False) == plain_trie(rows, heads=lambda c: 0)


def test_trie_of_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", None), (7, 1, "user", "b"), (7, 1, "user", "b"), (7, 1, "user", "a"), (203, 5, "", ""), (203, 1, "u", "ser"), (204, 1, "us", "er"), (300, 1, "user", "long " * 400_000), (301, 1, "user", "long " * 400_000), *((302, i, "user", "again") for i in range(300))]
    assert found_trie(spark, rows) == plain_trie(rows)
    assert found_trie(spark, []) == [] == found_trie(spark, rows[:1])
    # a conversation that loses all its turns is a member of the root
    lone = next(c for c in range(1001, 1100) if zlib.crc32(str(c).encode()) % 6 > 1)
    got = found_trie(spark, [(lone, 0, "user", "gone")])
    assert [x[:7] for x in got] == [(lone, 0, None, 1, 0, 1, 0)] and got[0][7] == hashlib.sha256(str(lone).encode()).hexdigest()


def test_id_digests_over_many_blocks(spark):
    ends = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("c"), F.when(F.col("id") % 10 < 7, F.lit(b"a")).otherwise(F.encode((F.col("id") % 20).cast("string"), "utf-8")).alias("digest"))
    want = defaultdict(list)
    for r in ends.collect():
        want[bytes(r.digest)].append(r.c)
    got = {bytes(r.digest): r.ends_sha256 for r in prefixtrie.id_digests(ends, block=13).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}


ODD = ["", "a", "It's  4,000 km — ’s!\n\n\tNEXT <|endoftext|>x<|startoftext|> <|endoftext|>", "é ́ ᾴ Σίσυφος ΟΔΟΣ ΟΔΟΣ.", "你好，世界。" * 9, "x" * 500, "<|end" + " oftext|>", "1 2 345 6789", "a  b   c \r\n d e　f", "𝔘𝔫𝔦 😀😀 👩‍👩‍👧", "don't I'LL we've", " lead and tail ", "a​b ﻿"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokens_against_whole_texts(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        plain = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = lambda t: len(own.encode(t))
    r = random.Random(2)
    words = [*ODD[1:], "the", "quick", "brown", "fox's", "42", "naïve", "Zoë", "。", "、", "一", "<|endoftext|>", "end\n"]
    texts = [*ODD, *ODD, *(r.choice(["", " ", "\n"]).join(r.choice(words) for _ in range(n)) for n in (5, 50, 400, 400, 3000)), "plain words only " * 30_000, "nobreak" * 4000]
    rows = [(i, t, "n", 7) for i, t in enumerate([*texts, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int")
    got = {x.doc_id: (x.n_bytes, x.n_tokens) for x in tokencount.count_tokens(df, path).collect()}
    assert got == {i: (len((t or "").encode()), plain(t or "")) for i, t, *_ in rows}
    assert tokencount.count_tokens(df.limit(0), path, keep=["doc_id"]).collect() == []
    # chunks as small as they get: every safe cut is taken
    counter = tokencount.Counter("json" if name.endswith("json") else "model", open(path, "rb").read())
    counter.chunk_chars = 1
    assert counter.cut is not None
    for t in texts[:-2]:
        assert int(counter.counts([t])[0]) == plain(t), t[:80]
        assert len(counter.chunks("one two three")) == 3
