"""Readers and sinks on generated files."""

import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from snapfold.functions import scalars
from snapfold.operators import calendar, followup, quality, rules, sampling, trajectories, usage
from snapfold.sources import bronze, exports


XML = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>oai:arXiv.org:2601.00001</identifier><datestamp>2026-01-01</datestamp></header><metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id>2601.00001</id><created>2026-01-01</created><updated>2026-01-02</updated><authors><author><keyname>Ada</keyname><forenames>A. B.</forenames></author><author><keyname>Bo</keyname></author></authors><title>T</title><categories>cs.CL cs.AI</categories><abstract>words &amp; more</abstract><doi>10.1/x</doi></arXiv></metadata></record>
<record><header status="deleted"><identifier>oai:arXiv.org:hep-th/9901001</identifier><datestamp>2026-01-01</datestamp></header></record>
<record><header><identifier>oai:arXiv.org:2601.00002</identifier></header><metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id>2601.00002</id><created>soon</created><title>U</title><categories>cs.CL 9bad</categories></arXiv></metadata></record>
<record><header><identifier>oai:arXiv.org:2601.00003</identifier><datestamp>2026-01-01</datestamp></header></record>
<record><header><identifier>oai:other</identifier><datestamp>2026-01-01</datestamp></header></record></ListRecords></OAI-PMH>"""
FEED = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>http://arxiv.org/abs/2301.00007v3</id><title>%s</title><summary>S</summary><published>2023-01-01T00:00:00Z</published><author><name>Cy</name></author><arxiv:doi>10.2/y</arxiv:doi><arxiv:primary_category term="cs.LG"/><category term="cs.LG"/><category term="cs.CL"/></entry></feed>"""


def zipped(path, data):
    with gzip.open(path, "wb") as f:
        f.write(data)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for day in ("2026-01-01", "2026-01-02"):
        (root / day).mkdir()
        listed = [
            {"id": "a/x", "author": "", "downloads": 5, "likes": 1, "createdAt": "2025-12-31T00:00:00.000Z", "gated": "auto", "tags": ["arxiv:2301.00001v2", "ARXIV:hep-th/9901001", "base_model:finetune:q", "base_model:quantized:b/c"]},
            {"id": "solo", "downloads": -1, "gated": False, "createdAt": 1767225600, "tags": "none"},
            {"downloads": 3},
            5,
            {"modelId": "m/only", "createdAt": "20260101", "lastModified": "never", "likes": "many"},
        ]
        lines = [json.dumps({"page": 1, "url": "http://page", "fetched_at": f"{day}T01:02:03Z", "http_status": 200, "body": listed}), "not json", "", json.dumps({"hf_id": "a/x", "http_status": 200, "body": {"id": "a/y"}})]
        data = "\n".join(lines).encode()
        zipped(root / day / "hf_top_models.jsonl.gz", data)
        cohort = [{"hf_id": "a/z", "http_status": 200, "fetched_at": f"{day}T02:00:00Z", "cohort_id": "c1", "discovery_sources": ["hf_top_models"], "body": {"id": "a/z", "downloads": 7, "likes": 0}}, {"hf_id": "a/q", "http_status": 200, "fetched_at": "1767225600", "body": {"downloads": 1}}]
        zipped(root / day / "hf_cohort.jsonl.gz", "\n".join(map(json.dumps, cohort)).encode())
        routes = {"data": [{"id": "p/m", "name": "M", "hugging_face_id": " ", "canonical_slug": "p/m-1", "context_length": 8, "created": 1767225600, "pricing": {"prompt": "0.1", "completion": "1"}, "architecture": {"modality": "text"}, "top_provider": {"max_completion_tokens": 4}}, {"id": "q/n", "canonical_slug": "p/m-1", "hugging_face_id": "a/x", "created": "soon"}, {"name": "no id"}]}
        zipped(root / day / "openrouter_models.json.gz", json.dumps(routes).encode())
        providers = [{"id": "a/x", "inferenceProviderMapping": [{"provider": "u", "providerId": "u/x", "status": "live", "task": "chat", "providerDetails": {"context_length": 9, "pricing": {"input": 1}}}, {"provider": "v", "status": "error"}, {"status": "live"}]}, {"id": "a/z", "inferenceProviderMapping": []}, {"id": "a/w"}]
        zipped(root / day / "hf_inference_providers.jsonl.gz", json.dumps({"fetched_at": f"{day}T03:00:00.25Z", "body": providers, "http_status": 200}).encode())
        zipped(root / day / "arxiv.jsonl.gz", json.dumps({"fetched_at": f"{day}T05:00:00Z", "records": ["1", "2"], "body_base64": base64.b64encode(XML.encode()).decode(), "http_status": 200}).encode())
        size = (root / day / "hf_top_models.jsonl.gz").stat().st_size
        good = {"status": "ok" if day.endswith("1") else "partial", "file": "hf_top_models.jsonl.gz", "sha256_raw": hashlib.sha256(data).hexdigest(), "bytes_stored": size}
        legs = {"hf_top_models": good, "openrouter_models": {"status": "ok", "file": "openrouter_models.json.gz", "bytes_stored": 1, "fetched_at": f"{day}T04:00:00Z", "url": "http://routes", "sha256_raw": "0"}, "hf_cohort": {"status": "partial", "file": "none.gz", "failures": [{"hf_id": "a", "reason": "identity_mismatch"}]}}
        (root / day / "_manifest.json").write_text(json.dumps({"status": "complete", "snapshot_date": day, "collected_at": f"{day}T00:30:00Z", "legs": legs}))
    return str(root)


def test_lines_are_numbered_in_their_file(spark, raw):
    found = bronze.lines(spark, f"{raw}/*/hf_top_models.jsonl.gz")
    assert sorted((r["day"], r["line"]) for r in found.where("value = 'not json'").collect()) == [("2026-01-01", 2), ("2026-01-02", 2)]


def test_repositories(spark, raw):
    rows, findings = bronze.repositories(spark, f"{raw}/*/hf_top_models.jsonl.gz", "hf_top_models")
    first = {r["hf_repo_id"]: r for r in rows.where("snapshot_date = date'2026-01-01'").collect()}
    assert set(first) == {"a/x", "solo", "m/only"}
    x = first["a/x"]
    assert x["arxiv_ids"] == ["2301.00001", "hep-th/9901001"] and x["base_model"] == "quantized:b/c" and x["author"] == "a" and x["gated"] == "auto" and x["source_url"] == "http://page" and x["discovery_sources_json"] == "[]"
    assert first["solo"]["author"] == "solo" and first["solo"]["gated"] == "False" and str(first["solo"]["created_at"]) == "2026-01-01 00:00:00" and first["solo"]["tags_json"] == "[]"
    assert str(first["m/only"]["created_at"]) == "2026-01-01 00:00:00"
    told = [(r["line"], r["error"]) for r in findings.where("day = '2026-01-01'").collect()]
    assert sorted(told) == sorted([(2, "bad envelope"), (4, "body is not a list"), (1, "row without an id"), (1, "row is no object"), (1, "invalid tags: solo"), (1, "invalid downloads: solo"), (1, "invalid likes: m/only"), (1, "invalid lastModified: m/only")])


def test_detail_legs(spark, raw):
    rows, findings = bronze.repositories(spark, f"{raw}/2026-01-01/hf_cohort.jsonl.gz", "hf_cohort")
    got = {r["hf_repo_id"]: r for r in rows.collect()}
    assert set(got) == {"a/z", "a/q"} and got["a/z"]["cohort_id"] == "c1" and got["a/z"]["discovery_sources_json"] == '["hf_top_models"]' and got["a/q"]["fetched_at"] is None
    assert got["a/q"]["source_url"] == "https://huggingface.co/api/models/a/q" and [r["error"] for r in findings.collect()] == ["invalid fetched_at: a/q"]
    found, _ = bronze.envelopes(spark, f"{raw}/2026-01-01/*.jsonl.gz")
    kept = bronze.bodies(found.where("file like '%hf_%models%' or file like '%cohort%'"), bronze.REPO)
    assert {r["id"] for r in kept.select("row.id").collect()} >= {"a/x", "a/z"} and kept.where("row.id = 'a/y'").count() == 0


def test_admission(spark, raw):
    told = bronze.manifests(spark, raw)
    rows, _ = bronze.repositories(spark, f"{raw}/*/hf_top_models.jsonl.gz", "hf_top_models")
    assert {str(r[0]) for r in bronze.admitted(rows, told, "hf_top_models").select("snapshot_date").distinct().collect()} == {"2026-01-01"}
    assert told.where("leg = 'hf_cohort'").select(F.explode("failures")).count() == 2


def test_catalogues(spark, raw):
    told = bronze.manifests(spark, raw)
    routes = {r["model_id"]: r for r in bronze.routes(spark, f"{raw}/2026-01-01/openrouter_models.json.gz", told).collect()}
    m = routes["p/m"]
    assert m["is_alias"] and m["alias_target"] == "p/m-1" and m["hugging_face_id"] is None and m["name"] == "M" and m["architecture_modality"] == "text" and str(m["created_at"]) == "2026-01-01 00:00:00" and str(m["fetched_at"]) == "2026-01-01 04:00:00"
    assert set(routes) == {"p/m", "q/n"} and routes["q/n"]["created_at"] is None
    assert sorted(r["error"] for r in bronze.route_findings(spark, f"{raw}/2026-01-01/openrouter_models.json.gz").collect()) == ["invalid created: q/n", "route without an id"]
    found = bronze.provider_mappings(spark, f"{raw}/2026-01-01/hf_inference_providers.jsonl.gz").collect()
    assert sorted((r["hf_repo_id"], r["provider"]) for r in found if r["provider"]) == [("a/x", "u"), ("a/x", "v")]
    assert next(r["locator"] for r in found if r["provider"] == "v") == "line[1].body[0].inferenceProviderMapping[1]"
    assert sorted(r["error"] for r in bronze.provider_findings(spark, f"{raw}/2026-01-01/hf_inference_providers.jsonl.gz").collect()) == ["malformed provider mapping: a/x", "no provider mapping: a/w"]
    claims = bronze.same_day_claims(spark, f"{raw}/*/openrouter_models.json.gz").where("snapshot_date = date'2026-01-02'").first()
    assert claims["canonical_slug"] == "p/m-1" and [(c["row_index"], c["hf_repo_id"]) for c in claims["claims"]] == [(0, " "), (1, "a/x")] and len(claims["claims"][0]["sha256_file"]) == 64


def test_papers(spark, raw):
    rows, findings = bronze.papers(spark, f"{raw}/2026-01-01/arxiv.jsonl.gz")
    rows = {r["arxiv_id"]: r for r in rows.collect()}
    one = rows["2601.00001"]
    assert one["authors"] == ["A. B. Ada", "Bo"] and one["primary_category"] == "cs.CL" and not one["deleted"] and one["abstract"] == "words & more" and one["doi"] == "10.1/x" and str(one["updated_at"])[:10] == "2026-01-02"
    assert rows["hep-th/9901001"]["deleted"] and rows["hep-th/9901001"]["title"] is None and set(rows) == {"2601.00001", "hep-th/9901001", "2601.00002"}
    assert sorted(r["error"] for r in findings.collect()) == sorted(["invalid identifier: oai:other", "missing metadata: 2601.00003", "invalid category: 2601.00002", "missing datestamp: 2601.00002", "invalid date: 2601.00002"])


def test_enrichment(spark, tmp_path):
    good = (FEED % "new").encode()
    zipped(tmp_path / "a.xml.gz", (FEED % "old").encode())
    zipped(tmp_path / "b.xml.gz", good)
    zipped(tmp_path / "c.xml.gz", b"<other/>")
    item = lambda status, name, **k: {"status": status, "response_file": name, "fetched_at": "2026-02-03T00:00:00Z", "sha256_raw": hashlib.sha256(good).hexdigest(), **k}
    items = {"2301.00007": item("resolved", "b.xml.gz", original_references=["2301.00007v1"]), "2301.00008": item("resolved", "a.xml.gz"), "2301.00009": item("not_found", "c.xml.gz"), "2301.00010": {"status": "error", "error": "timeout"}}
    (tmp_path / "_manifest.json").write_text(json.dumps({"items": items}))
    found, statuses, flaws = bronze.enrichment(spark, str(tmp_path))
    p = found.collect()
    assert len(p) == 1 and p[0]["arxiv_id"] == "2301.00007" and p[0]["title"] == "new" and p[0]["authors"] == ["Cy"] and p[0]["categories"] == ["cs.LG", "cs.CL"] and p[0]["primary_category"] == "cs.LG" and p[0]["doi"] == "10.2/y"
    assert {r["arxiv_id"]: r["resolution_status"] for r in statuses.collect()} == {k: v["status"] for k, v in items.items()}
    assert sorted((r["arxiv_id"], r["error"]) for r in flaws.collect()) == [("2301.00008", "resolved but absent from the stored response"), ("c.xml.gz", "not a feed")]


def test_backfill(spark, tmp_path):
    for run, status in (("one", "ok"), ("two", "failed")):
        (tmp_path / run).mkdir()
        zipped(tmp_path / run / "arxiv.jsonl.gz", json.dumps({"body_base64": base64.b64encode(XML.encode()).decode(), "http_status": 200}).encode())
        (tmp_path / run / "_manifest.json").write_text(json.dumps({"collected_at": "2026-03-04T23:00:00Z", "leg": {"status": status}}))
    rows, findings = bronze.backfill(spark, str(tmp_path))
    assert {str(r["observed_date"]) for r in rows.collect()} == {"2026-03-04"} and rows.count() == 3 and findings.count() == 5


def test_strata_and_extract(spark, tmp_path):
    page = lambda *names: json.dumps({"body": {"results": [{"owner": "o", "name": n, "run_count": i} for i, n in enumerate(names)]}}).encode()
    zipped(tmp_path / "a.jsonl.gz", page("x", "y"))
    zipped(tmp_path / "b.jsonl.gz", page("z", "x"))
    assert {r["key"]: r["run_count"] for r in bronze.strata(spark, f"{tmp_path}/*.jsonl.gz").collect()} == {"o/x": 0, "o/y": 1, "o/z": 0}
    (tmp_path / "e.csv").write_text("id,day,n\na,2026-01-01,3\nb,,\n")
    assert [tuple(r) for r in bronze.extract(spark, f"{tmp_path}/e.csv", "id string, day date, n long").orderBy("id").select("id", "n").collect()] == [("a", 3), ("b", None)]


def test_integrity(spark, raw):
    told = bronze.manifests(spark, raw)
    found = {(r["leg"], r["problem"]) for r in bronze.integrity(spark, f"{raw}/*/*.gz", told).collect()}
    assert found == {("openrouter_models", "size"), ("hf_cohort", "missing")}


def test_payload_index_and_facts(spark, raw):
    index = bronze.payload_index(spark, raw).cache()
    rows = {(str(r["collection_day"]), r["source"]): r for r in index.collect()}
    top = rows["2026-01-01", "hf_top_models"]
    assert top["integrity_status"] == "verified" and top["response_count"] == 3 and top["observed_basis"] == "response_envelope.fetched_at" and top["observed_precision"] == "second" and str(top["collection_date"]) == "2026-01-01"
    assert rows["2026-01-01", "openrouter_models"]["integrity_status"] == "mismatch" and rows["2026-01-01", "openrouter_models"]["source_record_count"] == 3 and rows["2026-01-01", "openrouter_models"]["observed_basis"] == "manifest.legs.fetched_at"
    assert rows["2026-01-01", "arxiv"]["source_record_count"] == 2 and rows["2026-01-01", "arxiv"]["model_observation_count"] is None and rows["2026-01-01", "arxiv"]["integrity_status"] == "unattested"
    assert rows["2026-01-01", "hf_cohort"]["source_record_count"] == 2 and rows["2026-01-02", "hf_inference_providers"]["observed_precision"] == "fractional_seconds_2"
    path = "2026-01-01/hf_top_models.jsonl.gz"
    stored = hashlib.sha256(open(f"{raw}/{path}", "rb").read()).hexdigest()
    assert top["snapshot_id"] == hashlib.sha256(f"{path}\n{stored}".encode()).hexdigest() and top["sha256_file"] == stored
    facts = {(r["provider"], r["provider_model_id"], str(r["observation_date"])): r for r in bronze.deployment_facts(spark, raw, index).collect()}
    assert len(facts) == 8
    u, m = facts["u", "u/x", "2026-01-01"], facts["openrouter", "p/m", "2026-01-02"]
    assert u["context"]["context_length"] == 9 and u["price_json"] == '{"input":1}' and u["provider_status"] == "live" and u["source_hf_repo_id"] == "a/x" and u["locator"] == "line[1].body[0].inferenceProviderMapping[0]"
    assert m["deployment_key"] == hashlib.sha256(b'["provider_deployment/1","openrouter","p/m"]').hexdigest() and m["context"]["max_completion_tokens"] == 4 and m["source_publisher"] == "p" and m["locator"] == "data[0]"
    assert facts["v", None, "2026-01-01"]["deployment_id_status"] == "missing_provider_model_id" and facts["v", None, "2026-01-01"]["deployment_key"] is None
    totals = bronze.archive_totals(spark, raw).first()
    assert totals["file_count"] == 10 and str(totals["min_timestamp"]) == "2026-01-01 00:30:00" and str(totals["max_timestamp"]) == "2026-01-02 04:00:00"
    assert rules.stale_index(index.select("snapshot_id", "sha256_raw"), bronze.payload_index(spark, raw)).count() == 0


def test_acknowledgements(spark, tmp_path):
    p = tmp_path / "gaps.txt"
    p.write_text("# why\n\n2026-01-03 upstream was down\n")
    assert [(str(r["day"]), r["reason"]) for r in bronze.acknowledgements(spark, str(p), False).collect()] == [("2026-01-03", "upstream was down")]


def test_exports(spark, tmp_path):
    shares = [{"date": "2026-01-01", "group": "model", "modality": "text", "name": n, "metric": "tokens", "share_percent": v} for n, v in (("Other", 60.0), ("m", 140.0), ("k", "40"), ("z", True))] + [{"date": "2026-02-01", "group": "app", "modality": "text", "name": "q", "metric": "tokens", "share_percent": 1}]
    tokens = [{"date": "2026-01-01", "model_permaslug": s, "model_name": n, "total_tokens": v} for s, n, v in (("a/b", "B", "12"), ("other", "Rest", 3), ("c", None, -1), ("d", "D", 1.5))]
    for k, (sha_ok, fetched, body) in enumerate([(True, "2026-01-02T00:00:00Z", {"rows": shares}), (False, "2026-01-03T00:00:00Z", {"data": []}), (True, "2026-01-04T00:00:00Z", {"meta": {"as_of": "2026-01-04"}, "data": tokens})]):
        d = tmp_path / "src" / "2026-01-01_2026-01-01" / f"s{k}"
        d.mkdir(parents=True)
        body = json.dumps(body).encode() if k < 2 else json.dumps(body).encode() + b"\n"
        (d / "response.json").write_bytes(body)
        (d / "manifest.json").write_text(json.dumps({"source": "s", "start_date": "2026-01-01", "end_date": "2026-01-02", "fetched_at": fetched, "url": "u", "sha256": hashlib.sha256(body).hexdigest() if sha_ok else "x"}))
    found = exports.revisions(spark, str(tmp_path))
    assert sorted(r["ok"] for r in found.collect()) == [False, True, True]
    rows = {(r["unit"], r["name"]): r for r in exports.usage_rows(found).collect()}
    assert rows["percent", "Other"]["is_other"] and rows["percent", "Other"]["value"] == 60 and all(rows["percent", n]["value"] is None for n in ("m", "k", "z")) and rows["percent", "Other"]["identity_status"] == "aggregate"
    assert not rows["percent", "q"]["in_range"] and not rows["percent", "q"]["in_scope"] and rows["percent", "Other"]["in_scope"]
    assert rows["tokens", "B"]["value"] == 12 and rows["tokens", "B"]["source_id"] == "a/b" and rows["tokens", "Rest"]["is_other"] and rows["tokens", "Rest"]["source_id"] is None and rows["tokens", "c"]["value"] is None and rows["tokens", "D"]["value"] is None and rows["tokens", "B"]["as_of"] == "2026-01-04"
    assert exports.new_occurrences(found).count() == 3
    metrics = spark.createDataFrame([("s", "tokens")], "source string, metric string")
    assert exports.expected_days(found, metrics).count() == 2


def test_share_series(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"result": {"serie_0": {"timestamps": ["2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"], "a": ["75", "x"], "other": ["25", "20", "9"], "short": ["0"]}}}))
    rows = exports.share_series(spark, str(p))
    assert rows.count() == 6 and {(r["name"], r["share"]) for r in rows.collect()} == {("a", 75.0), ("a", None), ("other", 25.0), ("other", 20.0), ("short", 0.0), ("short", None)}
    found = sorted((r["rule"], r["detail"]) for r in rules.series_rules(rows.withColumn("s", F.lit("s")), "s", "name", "position", "day", "share", "2026-01-01", "2026-01-03").collect())
    assert found == [("invalid_share", "a|2026-01-02"), ("invalid_share", "short|2026-01-02"), ("missing_day", "2026-01-03"), ("sum_not_100", "2026-01-02")]


def test_ledger_and_registry(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps([{"source": "s", "source_model_id": "m", "hf_repo_id": "a/b", "valid_from": "2026-01-01", "valid_until": "2026-01-31", "reviewer": "who", "evidence_url": "u"}]))
    assert exports.ledger(spark, str(tmp_path / "l.json")).first()["hf_repo_id"] == "a/b"
    (tmp_path / "c.json").write_text(json.dumps({"cohort_id": "c1", "selected_at": "2026-01-01T00:00:00Z", "members": [{"hf_repo_id": "a/b", "selection_group": "recent"}, {"hf_repo_id": "a b", "active": False, "enrolled_at": "2026-01-02T00:00:00"}]}))
    rows = exports.registry(spark, str(tmp_path / "c.json"))
    assert {(r["hf_repo_id"], r["active"], r["enrolled_at"]) for r in rows.collect()} == {("a/b", True, "2026-01-01T00:00:00Z"), ("a b", False, "2026-01-02T00:00:00")}
    assert sorted((r["subject"], r["rule"]) for r in rules.registry_rules(rows).collect()) == [("a b", "enrolled_at"), ("a b", "member_id")]
    seen = rows.select("hf_repo_id").where("hf_repo_id = 'a/b'")
    members = followup.enrolled(rows, F.lit("2026-01-01").cast("date"))
    assert [r[0] for r in members.collect()] == ["a/b"] and followup.to_poll(members, seen.limit(0), seen).count() == 0


def test_scalars(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first()["x"]
    texts = ["hep-th/9901001V2", " arXiv:2301.00001v1 ", "math.AG/0000000", "0703.0001", "0704.00001", "2313.00001", "ARXIV:2301.00001"]
    ids = [get(scalars.paper_id(F.lit(t))) for t in texts]
    assert ids == ["hep-th/9901001", "2301.00001", "math.AG/0000000", "0703.0001", "0704.00001", "2313.00001", None]
    assert [get(scalars.valid_paper_id(F.lit(i).cast("string"))) for i in ids] == [True, True, False, False, True, False, False]
    for text, expected in (("0.10", "0.1"), ("1e2", "100"), ("-0", "0"), ("+5.", "5"), ("00.50", "0.5"), (".5", "0.5"), ("123456789012345678901234567890.10", "123456789012345678901234567890.1"), ("free", None), ("10", "10"), ("", None), ("1.", "1")):
        assert get(scalars.plain_decimal(F.lit(text))) == expected, text
    price = lambda j: tuple(get(scalars.price_of(F.parse_json(F.lit(j)))) or ())
    assert price("true") == ("boolean", "true") and price("1.50") == ("decimal", "1.5") and price('"1.5"') == ("decimal", "1.5") and price("null") == () and price('"x"') == ("string", '"x"')
    leaf = get(scalars.leaves(F.parse_json(F.lit('{"a":{"b":1,"c":null,"d":["y","x"]},"e":"q"}')), unordered=True))
    assert leaf == {"a.b": "1", "a.d": '["x","y"]', "e": '"q"'}
    assert get(scalars.author(F.lit(""), F.lit("a/b"))) == "a" and get(scalars.author(F.lit(None).cast("string"), F.lit("solo"))) == "solo"
    assert get(scalars.instant(F.lit("20240101"))).isoformat() == "2024-01-01T00:00:00" and get(scalars.instant(F.lit("2024"))) is None and get(scalars.instant(F.lit("1704067200"))) is None
    assert get(scalars.paper_of(F.lit("https://arxiv.org/pdf/2301.00001v2.pdf"))) == "2301.00001"


def test_shapes_never_bridge_a_gap(spark):
    rows = spark.createDataFrame([("r", f"2026-01-0{d}", v) for d, v in ((1, 1.0), (2, None), (3, 5.0), (4, 4.0), (5, 6.0))], "id string, day string, v double").withColumn("day", F.to_date("day"))
    r = trajectories.shapes(rows, "id", "day", "v").first()
    assert r["total_variation"] == 3.0 and r["reversals"] == 1 and r["peak"] == 6.0 and r["peak_rise"] == 5.0 and r["peak_fall"] == 0.0 and not r["interior_peak"] and r["up_share"] == 0 and r["n_blocks"] == 1
    none = trajectories.shapes(rows.withColumn("v", F.lit(None).cast("double")), "id", "day", "v").first()
    assert none["peak"] is None and none["total_variation"] == 0 and none["volatility"] is None and none["peak_rise"] == 0


def test_members_fill_up(spark):
    rows = spark.createDataFrame([(f"o{i % 3}/m{i}", i, None, f"o{i % 3}") for i in range(20)], "id string, n int, created date, org string")
    for version in (1, 2):
        got = sampling.members(rows, "id", "n", "created", "org", 9, "seed", version).collect()
        assert [r["stratum"] for r in got].count("popular") == 3 and [r["stratum"] for r in got].count("remaining") == 6
    key = rows.where("id = 'o0/m0'").select(sampling.sample_key("s:1", "d", "id")).first()[0]
    assert key == hashlib.sha256(b'["s:1","d","o0/m0"]').hexdigest()


def test_facts_that_are_equal_stay_apart(spark):
    facts = spark.createDataFrame([("k", "2026-01-01")] * 2, "k string, day string").withColumn("day", F.to_date("day"))
    ledger = spark.createDataFrame([("k", "2025-01-01", None, "t", "who", "ref")], "k string, valid_from string, valid_until string, target string, reviewer string, evidence string").withColumns({"valid_from": F.to_date("valid_from"), "valid_until": F.to_date("valid_until")})
    assert usage.in_force(facts, ledger, "k", "day").count() == 2


def test_sinks_and_gate(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    exports.write_table(df, str(tmp_path / "t"), ["name", "id"], ["id"])
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["name", "id"]
    exports.write_csv(df, str(tmp_path / "c"))
    exports.write_report(df.agg(F.count("*").alias("n")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first()["n"] == 2 and spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    assert [r["n_all"] for r in exports.sample_of_errors(df, ["id"], 1).collect()] == [2]
    bad = quality.violations(df, "id", {"above_one": F.col("id") > 1})
    with pytest.raises(ValueError):
        quality.gate(bad)
    assert quality.gate(bad, fail=False).first()["n"] == 1


def test_typed_tables_and_summary(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    exports.write_typed(df, str(tmp_path / "t"), "name string, id long", ["id"])
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == [("name", "string"), ("id", "bigint")]
    for schema in ("id long", "name string, id long, more int", "name int, id long"):
        with pytest.raises(Exception):
            exports.write_typed(df, str(tmp_path / "u"), schema)
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-09",)], "day string").withColumn("day", F.to_date("day"))
    r = quality.build_summary({"a": df, "b": df.limit(0)}, days, "day", df.withColumnRenamed("id", "rule"), 1).first()
    assert r["rows"] == {"a": 2, "b": 0} and r["maximum_followup_days"] == 8 and r["n_findings"] == 2 and len(r["findings"]) == 1


def test_ranges_of_completed_days():
    assert calendar.report_window(7, "2026-02-01") == ("2026-01-25", "2026-01-31") and calendar.report_window(1, "2026-02-01", "2026-01-03") == ("2026-01-03", "2026-01-03")
    for call in (lambda: calendar.report_window(31, "2026-02-01"), lambda: calendar.completed_range("2026-01-02", "2026-01-01", "2026-02-01"), lambda: calendar.completed_range("2026-01-01", "2026-02-01", "2026-02-01")):
        with pytest.raises(ValueError):
            call()


def test_files_in_order_are_the_sorted_table(spark, tmp_path):
    """A third of the rows has one key, a sixth is one row again and again."""
    rows = [(5, i) for i in range(2000)] + [(7, 0)] * 1000 + [(i % 97, -i) for i in range(3000)]
    exports.write_table(spark.createDataFrame(rows, "a long, b long").repartition(5), str(tmp_path / "t"), ["b", "a"], ["a"], files=12)
    files = sorted((tmp_path / "t").glob("part-*"))
    read = [[r["a"] for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert [a for f in read for a in f] == sorted(a for a, _ in rows) and len(read) == 12
    assert sum(5 in f for f in read) >= 3 and sum(7 in f for f in read) >= 2 and max(map(len, read)) < 1500
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["b", "a"]


def test_a_report_is_one_document(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(50)], "a long, b string").repartition(4)
    exports.write_report(df, str(tmp_path / "r/rows.json"), ["a"])
    assert json.loads((tmp_path / "r/rows.json").read_text()) == [{"a": i, "b": None if i % 2 else "x"} for i in range(50)]
    exports.write_report(df.agg(F.count("*").alias("n")), f"file://{tmp_path}/r/one.json")
    assert json.loads((tmp_path / "r/one.json").read_text()) == {"n": 50}
    with pytest.raises(ValueError):
        exports.write_report(df, str(tmp_path / "r/bad.json"))
    exports.write_report(df.limit(0), str(tmp_path / "r/none.json"), ["a"])
    assert json.loads((tmp_path / "r/none.json").read_text()) == [] and not (tmp_path / "r/bad.json").exists()
