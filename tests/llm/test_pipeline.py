"""Stages of the pipeline on each other's results, and whose scratch data goes when."""

import random
from collections import Counter

import numpy as np

import corpus_pipeline as pipeline
from snapfold.llm import common, langid, mixing, passages, suffixes


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)


def test_stages_chain_without_writing(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    lazy = ids(pipeline.decontaminate(spark, pipeline.substring_dedup(spark, pipeline.near_dedup(spark, docs, odd), odd), odd))
    kept = docs
    for i, stage in enumerate((pipeline.near_dedup, pipeline.substring_dedup, pipeline.decontaminate)):
        stage(spark, kept, odd).write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
    assert lazy == ids(kept) and 0 < len(ids(kept)) < docs.count()


def test_other_results_stay_readable(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    other = suffixes.texts_without_repeats(docs)
    pipeline.near_dedup(spark, docs, odd).count()
    assert pipeline.mix(spark, docs, odd).count() == docs.count() == other.count()


def test_run_leaves_one_folder(spark, odd):
    from pathlib import Path

    shared = Path(common.shared_dir(spark).removeprefix("file:"))
    before, owned = set(shared.iterdir()), common.made()
    out = pipeline.run(spark, odd)
    left = {p.name for p in set(shared.iterdir()) - before if not p.name.startswith("rows_")}
    assert common.made() <= owned and [n.rsplit("-", 1)[0] for n in left if "-" in n] == ["mixing"] and out.count() > 0


def test_rows_without_ids_are_learnt_from(spark):
    """A draw of ids alone took all rows of a null or a common id, or none."""
    words = {"en": "the and of this that is", "de": "der und das nicht ein ist"}
    rows = [(None if i % 2 else 7, f"{words[lang]} {i} " * 20, lang) for i in range(1500) for lang in words]
    drawn = langid.training_windows(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    n = {r["lang"]: r["count"] for r in drawn.groupBy("lang").count().collect()}
    assert set(n) == set(words) and all(langid.DOCS_PER_LANG <= v <= langid.DOCS_PER_LANG * langid.WINDOWS_PER_DOC for v in n.values())


def test_passages_of_fifty_words_go(spark):
    """Strings of 400 bytes alone left passages of fifty short words in place."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    texts = [[word() for _ in range(rng.randint(0, 160))] for _ in range(40)] + [None, [], ["a"] * 49, ["b"] * 50, ["c"] * 51, ["d", "e"] * 40]
    for n in (49, 50, 51, 60, 90):
        shared = [word() for _ in range(n)]
        for i in rng.sample(range(40), 2):
            at = rng.randint(0, len(texts[i]))
            texts[i] = texts[i][:at] + shared + texts[i][at:]
    texts.append(texts[0])
    gap = lambda: rng.choice([" ", "  ", "\n", " \t"])
    rows = [(i, None if t is None else "".join(w + gap() for w in t)) for i, t in enumerate(texts)]
    many = Counter(tuple(t[s : s + 50]) for t in texts if t for s in range(len(t) - 49))
    expected = {}
    for i, t in enumerate(texts):
        gone = {j for s in range(len(t or []) - 49) if many[tuple(t[s : s + 50])] > 1 for j in range(s, s + 50)}
        expected[i] = None if t is None else [w for j, w in enumerate(t) if j not in gone]
    out = pipeline.substring_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert {i: None if t is None else t.split() for i, t in got.items()} == expected
    assert all(got[i] == t for i, t in rows if t is None or expected[i] == texts[i]) and sum(expected[i] != t for i, t in enumerate(texts)) > 6


def test_texts_are_mixed_where_they_are(spark, odd, monkeypatch):
    """A join with one row for each range of a source shuffled all texts once it was too large to broadcast."""
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    placed = []
    monkeypatch.setattr(mixing, "written", lambda df, label, **k: placed.append(common.written(df, label, **k)) or placed[-1])
    assert pipeline.mix(spark, docs, odd).count() == docs.count()
    assert placed[-1].count() == docs.select("source").distinct().count()


def test_shifts_are_tried_where_no_passage_is_equal(monkeypatch):
    """All shifts were compared for every row, also for those whose equal passage was known; the outcome is that of one row at a time."""
    rng = np.random.default_rng(6)
    width, wide = 2 * passages.LEAST - 1, 2 * (passages.LEAST - 1 + passages.BAND) + 1
    a, b = rng.integers(0, 1 << 32, (60, width)), rng.integers(0, 1 << 32, (60, wide))
    for i in range(40):
        b[i, passages.BAND : passages.BAND + width] = a[i]
        b[i, rng.integers(0, wide, i // 2)] = -2
    b[40:50, : width] = a[40:50]
    seen = []
    zeros = np.zeros
    monkeypatch.setattr(passages.np, "zeros", lambda shape, *k, **n: seen.append(shape) or zeros(shape, *k, **n))
    maybe, first, last = passages.alike_many(a, b)
    monkeypatch.undo()
    assert (60, width) not in seen
    for i in range(60):
        same = (a[i] == b[i, passages.BAND : passages.BAND + width]).astype(int)
        runs = [j for j in range(width - passages.LEAST + 1) if same[j : j + passages.LEAST].all()]
        met = np.array([(a[i] == b[i, d : d + width]) for d in range(2 * passages.BAND + 1)]).any(0).astype(int)
        most = max(met[j : j + passages.LEAST].sum() for j in range(width - passages.LEAST + 1))
        assert first[i] == (runs[0] if runs else -1) and maybe[i] == (not runs and most >= 41)
        assert not runs or same[first[i] : last[i] + 1].all()
