"""The pipeline's stages against plain versions, one after the other, on a small corpus."""

import random

from test_jaccard import plain as plain_groups
from test_tables import plain_hits, plain_lines

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(12)
    parts = {"en": ["the", "ing", "wh", "th", "on", "er"], "fr": ["eux", "oi", "que", "ré", "ai", "ou"]}
    prose = lambda k, n: " ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 3))) for _ in range(n))
    license_ = "Licensed to all who read this line of more than forty letters"
    items = [(k, prose("en", 20)) for k in range(3)]
    rows = []
    for i in range(60):
        k = r.choice(["en", "fr"])
        text = "\n".join(prose(k, r.randint(10, 40)) for _ in range(3))
        if i % 4 == 0:
            text += "\n" + license_
        if i % 15 == 1:
            text += " " + items[i % 3][1]
        rows.append((i, text, k, f"s{i % 3}", len(text)))
    base = prose("en", 120)
    for i in range(6):
        w = base.split()
        if i:
            w[r.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w), "en", None, len(base)))
    return [*rows, (200, None, None, "s0", None), (201, "", "en", "s0", 0), (202, "12 34", None, "s1", 5), (203, rows[5][1], "fr", "s2", 1)], items


def test_stages(spark, tmp_path):
    rows, items = corpus()
    at = str(tmp_path)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    texts = {r[0]: r[1] for r in rows}
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, at)
        got = {r.doc_id: r for r in out.collect()}
        if name == "language":
            assert set(got) == {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            want = plain_lines([(i, t, None) for i, t in kept.items()])
            assert sorted((str(i), r.text) for i, r in got.items()) == [(i, t) for i, _, _, t in want]
            assert all(r.n_chars == len(r.text) for r in got.values())
        elif name == "near_duplicates":
            assert set(got) == {i for i, n, c in plain_groups(sorted(kept.items()), 5, 80) if not n or i == c}
        elif name == "decontaminate":
            bad = {int(i) for i, n, h, _ in plain_hits([(i, t, None) for i, t in kept.items()], items) if h and 20 * h >= n}
            assert bad and set(got) == set(kept) - bad
        else:
            assert set(got) == set(kept) and all(r.size == len((kept[i] or "").split()) and r.taken == r.copies * r.size for i, r in got.items())
            break
        assert out.columns == list(corpus_pipeline.COLUMNS)
        kept = {i: r.text for i, r in got.items()}
        docs = spark.createDataFrame([tuple(r) for r in got.values()], SCHEMA)
    whole = corpus_pipeline.run(spark, at)
    assert {r.doc_id: r.taken for r in whole.collect()} == {i: r.taken for i, r in got.items()}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeats_ties_and_nulls(spark, tmp_path):
    """Rows that share an id, null ids, null and empty texts, ties; extra columns are left off."""
    base = "the wh ing on er th " * 8
    rows = [(1, base + "one", "en", "b", 1), (1, base + "one", "en", "a", 1), (1, "eux oi que ai ou ré " * 9, "fr", "a", 2), (None, base + "one", "en", None, 3), (7, None, None, None, None), (8, "", "en", "s", 0), (9, "12", None, "s", 2)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", copies string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, str(tmp_path))
    assert kept.columns == list(corpus_pipeline.COLUMNS) and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "1", "None"]
    kept = stages["near_duplicates"](spark, kept, str(tmp_path))
    assert sorted((r.doc_id, r.source, r.lang) for r in kept.collect()) == [(1, "a", "en"), (1, "a", "fr")]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == [1, 1]
