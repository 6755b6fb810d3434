import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, score int, h string"
VOCABULARY = {
    "en": [a + b for a in ("th", "an", "er", "on", "sh", "wh") for b in ("e", "at", "is", "ing", "ed", "ly")],
    "de": [a + b for a in ("sch", "ein", "pf", "ver", "ü", "zu") for b in ("ung", "heit", "en", "keit", "lich", "st")],
}


def prose(rng, n, lang="en"):
    return " ".join(rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "a", "or", "il"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and columns of clashing names."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, prose(rng, 30 + i * 3, lang), lang, f"src{i % 4}", 1, "u", 2, "h"))
    rows += [(100 + i, t, None, None, None, None, None, None) for i, t in enumerate([None, "", " \t\n", "!!! 123", "é", "a"])]
    rows += [rows[3], rows[3], (None, rows[4][1], "en", None, 0, None, None, None), (200, rows[5][1], "en", "src1", 0, None, None, None)]
    rows.append((201, prose(rng, 20000), "en", "src1", 0, None, None, None))
    rows.append((202, "\n".join([prose(rng, 8)] * 300), "en", "src2", 0, None, None, None))
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    item = " ".join(rows[20][1].split()[5:40])
    spark.createDataFrame([(0, item), (1, None), (2, ""), (3, prose(rng, 30, "de")), (None, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    pages = [(i, f"http://x/{i}", "p" * 150 if i % 3 else f"<p>{i}</p>") for i in range(12)] + [(20, None, None), (21, "u\r\nv", ""), (None, "n", "p" * 150), (5, "again", "p" * 150), (22, "s", "same"), (23, "s", "same")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    labels = [(i, i % 2, i % 3 // 2) for i in range(12)] + [(20, None, None), (21, 1, None), (21, None, 1), (5, 0, 0), (None, 0, 1), (999, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    talk = [(1, 0, "user", "hi"), (1, 1, "assistant", r"</s>[INST] \0 \1 <|turn|> x"), (1, 1, "assistant", r"</s>[INST] \0 \1 <|turn|> x"), (2, None, None, None), (3, 0, "assistant", ""), (None, 0, "<|end|>", "<s>")]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="session")
def nothing(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nothing"))
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        spark.read.parquet(f"{odd}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.fixture(scope="session")
def documents(spark, odd):
    return [tuple(r) for r in spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
