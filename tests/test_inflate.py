"""Files read in blocks: lines, elements, sizes and hashes, in bounded memory."""

import gzip
import hashlib
import json
import random
import subprocess
import sys
import zlib

import pytest

from snapfold.sources import bronze, inflate, xml


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def stored(tmp_path_factory):
    top = tmp_path_factory.mktemp("stored")
    rng = random.Random(3)
    long = "x" * (3 * inflate.BLOCK + 7)
    texts = {
        "2026-01-01/a.jsonl.gz": b"one\r\ntwo\n\n" + "drei ü\n".encode() + b"last",
        "2026-01-01/b.jsonl.gz": f"{long}\nshort\n{long}".encode(),
        "2026-01-02/a.jsonl.gz": b"",
        "2026-01-02/c.txt": b"plain\ntext\n",
        "2026-01-03/a.jsonl.gz": "\n".join(json.dumps({"i": i, "x": rng.random()}) for i in range(30_000)).encode() + b"\n",
    }
    for name, text in texts.items():
        path = top / name
        path.parent.mkdir(exist_ok=True)
        half = len(text) // 3
        path.write_bytes(text if not name.endswith(".gz") else gzip.compress(text[:half]) + gzip.compress(text[half:]) + b"\0" * 9)
    (top / "2026-01-01/_manifest.json").write_text("{}")
    return top, texts


def test_lines_are_those_of_the_whole_text(spark, stored):
    top, texts = stored
    expected = []
    for name, text in texts.items():
        if name.endswith("a.jsonl.gz") or "b.jsonl" in name:
            expected += [(name, i, v) for i, v in enumerate(text.decode().replace("\r\n", "\n").split("\n"), 1)]
    got = inflate.inflated(spark, f"{top}/*/{{a,b}}.jsonl.gz").collect()
    tell = lambda x: sorted(((n, i, v) for n, i, v in x if v), key=str)
    assert tell(("/".join(r["file"].split("/")[-2:]), r["line"], r["value"]) for r in got) == tell(expected)
    assert {r["file"] for r in got} <= {f"file://{top}/{n}" for n in texts}


def test_digests(spark, stored):
    top, texts = stored
    got = {"/".join(r["file"].split("/")[-2:]): tuple(r)[1:] for r in inflate.inflated(spark, f"{top}/*/*", "digests").collect()}
    assert got == {
        n: (len(kept := (top / n).read_bytes()), hashlib.sha256(kept).hexdigest(), len(t), hashlib.sha256(t).hexdigest(), sum(bool(x.strip()) for x in t.split(b"\n"))) for n, t in texts.items()
    }
    assert bronze.files(spark, f"{top}/2026-01-02").count() == 2 and inflate.inflated(spark, f"{top}/none*/x").count() == 0


@pytest.mark.parametrize("damage", [lambda b: b[:-12], lambda b: b[:40] + b"\xff\xff\xff" + b[43:], lambda b: b + b"trailing"])
def test_damaged_files_are_named(spark, tmp_path, damage):
    (tmp_path / "bad.jsonl.gz").write_bytes(damage(gzip.compress(random.Random(1).randbytes(5000))))
    with pytest.raises(Exception, match="bad.jsonl.gz"):
        inflate.inflated(spark, f"{tmp_path}/bad.jsonl.gz", "digests").collect()


def test_a_member_of_three_gigabytes_in_bounded_memory(tmp_path):
    """Lines of 3 GB in one member, read under a limit of 700 MB of address space."""
    line = b'{"body": "' + b"abcdefghij" * 100 + b'"}\n'
    block, n, folded = line * 1000, 3_000, 0
    path = tmp_path / "large.jsonl.gz"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    with path.open("wb") as f:
        for _ in range(n):
            f.write(packer.compress(block))
            folded += len(block)
        f.write(packer.flush())
    code = """
import resource, sys
from snapfold.sources import inflate
resource.setrlimit(resource.RLIMIT_DATA, (700 << 20, 700 << 20))
reader = inflate.InflatedReader(sys.argv[1], "lines", None, None)
part, = reader.partitions()
n = size = 0
for b in reader.read(part):
    n, size, last = n + len(b), size + b.column(2).nbytes, b.column(1)[-1].as_py()
print(n, last)
"""
    out = subprocess.run([sys.executable, "-c", code, str(path)], capture_output=True, text=True, cwd=str(inflate.__file__).rsplit("/snapfold/", 1)[0])
    assert out.stdout.split() == [str(1000 * n)] * 2, out.stderr[-2000:]
    assert folded > 3_000_000_000


PAGE = b"""<?xml version="1.0"?><!-- <record>no</record> -->
<o:OAI xmlns:o="urn:o" xmlns="urn:d" xmlns:x="urn:x"><ListRecords>
<record><header o:status="deleted" a="1"><id>1</id></header></record>
<record><t><![CDATA[a < b & </record> <record>]]></t><x:sub/><!-- in --></record>
<record><record>inner</record> tail</record>
<x:record>z &amp; \xc3\xbc</x:record><other>no</other></ListRecords></o:OAI>"""


@pytest.mark.parametrize("step", [1, 7, 10_000])
def test_elements_by_a_pull_parser(step):
    got = list(xml.elements((PAGE[i : i + step] for i in range(0, len(PAGE), step)), "record"))
    assert got == [(x, None) for x in (
        '<record><header status="deleted" a="1"><id>1</id></header></record>', "<record><t>a &lt; b &amp; &lt;/record&gt; &lt;record&gt;</t><sub /></record>", "<record><record>inner</record> tail</record>", "<record>z &amp; ü</record>",
    )]
    broken = list(xml.elements([PAGE[:-9]], "record"))
    assert len(broken) == 5 and broken[-1][0] is None and broken[-1][1]
    assert list(xml.elements([PAGE], "record", root="feed")) == [(None, "not a feed")]


def test_elements_let_go_of_what_was_read():
    import tracemalloc

    tracemalloc.start()
    n = sum(1 for _ in xml.elements([b"<a>"] + [b"<r>" + b"x" * 1000 + b"</r><skip>" + b"y" * 1000 + b"</skip>\n"] * 30_000 + [b"</a>"], "r"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 30_000 and peak < 8 << 20


def test_records_of_a_column(spark):
    df = spark.createDataFrame([(1, PAGE), (2, b"<a><record>"), (3, None), (4, b"<a/>")], "id long, d binary")
    got = {r["id"]: r["x"] for r in df.select("id", xml.records(df["d"], "record").alias("x")).collect()}
    assert len(got[1]) == 4 and got[2] is None and got[3] is None and got[4] == []
