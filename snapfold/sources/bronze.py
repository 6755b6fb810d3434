"""Readers of raw snapshots: one folder a UTC day, one gzip file a source, and a manifest.

Paths are ``<root>/<day>/<leg>.jsonl.gz`` (envelopes), ``<leg>.json.gz`` (one document) and ``_manifest.json``. Every
reader keeps file, line (from 1) and position, so that ties in later steps go by the order of the files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import author, bad_instant, base_model, instant, instant_of, observation_date, paper_id, paper_ids, precision, strict_instant
from ..session import importable
from .inflate import inflated
from .xml import records

DAY = r"(\d{4}-\d{2}-\d{2})/[^/]+$"
ENVELOPE = "page long, url string, source_url string, hf_id string, cohort_id string, discovery_sources array<string>, fetched_at string, http_status int, body string, body_base64 string, records array<string>"
REPO = "id string, modelId string, downloads long, likes long"
LEG = "struct<status:string,file:string,sha256_raw:string,bytes_raw:long,bytes_stored:long,fetched_at:string,rows:long,requested:long,stored:long,url:string,scope:string,filter:string,sort:string,target_rows:long,pagination_complete:boolean,failures:array<struct<hf_id:string,id:string,reason:string,http_status:int,response_id:string,measured_at:string>>,deferred:array<struct<hf_id:string,reason:string>>,cohort_id:string>"
#: Legs whose envelopes hold one object each; the others hold lists.
DETAIL = ("hf_models", "hf_cohort")
CATEGORY = "[A-Za-z][A-Za-z0-9.-]*"


def _day(file: Column) -> Column:
    return F.regexp_extract(file, DAY, 1)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """day, file, line, value of text files; a file is read by one task in blocks, as gzip can't be split."""
    return inflated(spark, path).select(_day(F.col("file")).alias("day"), "file", "line", "value")


def envelopes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Parsed envelopes, and the lines that are none as findings."""
    parsed = lines(spark, path).where(F.trim("value") != "").withColumn("e", F.from_json("value", ENVELOPE))
    good = F.col("e.body").isNotNull() | F.col("e.body_base64").isNotNull() | F.col("e.http_status").isNotNull()
    bad = parsed.where(~F.coalesce(good, F.lit(False))).select("day", "file", "line", F.lit("bad envelope").alias("error"))
    return parsed.where(good).select("day", "file", "line", "e.*"), bad


def bodies(found: DataFrame, schema: str) -> DataFrame:
    """Envelope bodies as rows: a list gives one each, a single object counts if its ids are those asked for."""
    v = F.try_parse_json("body")
    is_list = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    one = F.from_json("body", schema)
    kept = ["day", "file", "line", "fetched_at", "http_status", "url", "source_url"]
    listed = found.where(is_list).select(*kept, F.posexplode(items).alias("position", "v")).select(*kept, "position", F.from_json(F.to_json("v"), schema).alias("row"))
    ids = F.array_compact(F.array(one["id"], one["modelId"]))
    same = (F.size(ids) > 0) & F.forall(ids, lambda x: x.eqNullSafe(F.col("hf_id")))
    single = found.where(~is_list & same).select(*kept, F.lit(0).alias("position"), one.alias("row"))
    return listed.unionByName(single)


def _findings(rows: DataFrame, rules: dict[str, Column], subject: Column | None = None) -> DataFrame:
    """day, file, line, error of every rule that a row meets; ``subject`` names the row."""
    about = F.lit("") if subject is None else F.coalesce(F.concat(F.lit(": "), subject), F.lit(""))
    met = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return rows.select("day", "file", "line", F.explode(met).alias("rule"), about.alias("about")).select("day", "file", "line", F.concat("rule", "about").alias("error"))


def repositories(spark: SparkSession, path: str, leg: str) -> tuple[DataFrame, DataFrame]:
    """Observations of repositories by one leg, and findings, which drop a row only where it can't be told what it is of."""
    found, bad = envelopes(spark, path)
    found = found.withColumn("v", F.try_parse_json("body"))
    whole = F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))
    items = F.array(F.col("v")) if leg in DETAIL else F.when(whole, F.try_variant_get("v", "$", "array<variant>"))
    kept = ["day", "file", "line", "fetched_at", "hf_id", "cohort_id", "discovery_sources", "url", "source_url"]
    rows = found.select(*kept, F.posexplode(items).alias("position", "row"))
    get = lambda name, kind="string": F.try_variant_get("row", f"$.{name}", kind)
    kind_of = lambda name: F.schema_of_variant(get(name, "variant"))
    rows = rows.withColumn("is_row", F.coalesce(F.schema_of_variant("row").startswith("OBJECT"), F.lit(False)))
    empty = lambda c: F.nullif(c, F.lit(""))
    rows = rows.withColumn("id", F.coalesce(empty(get("id")), empty(get("modelId")), empty(F.col("hf_id"))))
    tagged = F.coalesce(kind_of("tags").startswith("ARRAY"), F.lit(False))
    rows = rows.withColumn("tags", F.when(tagged, F.filter(F.transform(get("tags", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>")))
    there = lambda name: get(name, "variant").isNotNull() & (kind_of(name) != "VOID")
    count = lambda name: there(name) & ((kind_of(name) != "BIGINT") | (get(name, "long") < 0))
    rows = rows.withColumns({"created": instant_of(get("createdAt", "variant")), "modified": instant_of(get("lastModified", "variant")), "fetched": instant(F.col("fetched_at"))})
    good = rows.where("is_row and id is not null")
    gated = get("gated", "variant")
    out = good.select(
        F.col("id").alias("hf_repo_id"),
        F.to_date("day").alias("snapshot_date"),
        F.lit(leg).alias("source_leg"),
        F.col("fetched").alias("fetched_at"),
        "cohort_id",
        F.to_json(F.coalesce("discovery_sources", F.array().cast("array<string>"))).alias("discovery_sources_json"),
        author(get("author"), F.col("id")).alias("author"),
        get("downloads", "long").alias("downloads_30d"),
        get("likes", "long").alias("likes"),
        F.col("created").alias("created_at"),
        F.col("modified").alias("last_modified"),
        get("library_name").alias("library_name"),
        get("pipeline_tag").alias("pipeline_tag"),
        get("private", "boolean").alias("private"),
        F.when(there("gated"), F.when(kind_of("gated") == "BOOLEAN", F.initcap(F.try_variant_get(gated, "$", "string"))).otherwise(F.try_variant_get(gated, "$", "string"))).alias("gated"),
        get("disabled", "boolean").alias("disabled"),
        paper_ids(F.col("tags")).alias("arxiv_ids"),
        base_model(F.col("tags")).alias("base_model"),
        F.to_json("tags").alias("tags_json"),
        F.coalesce(empty(F.col("source_url")), empty(F.col("url")), F.concat(F.lit("https://huggingface.co/api/models/"), F.col("id"))).alias("source_url"),
        "file",
        "line",
        "position",
    )
    told = bad if leg in DETAIL else bad.unionByName(_findings(found, {"body is not a list": ~whole}))
    told = told.unionByName(_findings(rows, {"row is no object": ~F.col("is_row"), "row without an id": F.col("is_row") & F.col("id").isNull()}))
    rules = {
        "invalid tags": there("tags") & ~tagged,
        "invalid downloads": count("downloads"),
        "invalid likes": count("likes"),
        "invalid createdAt": bad_instant(get("createdAt", "variant"), F.col("created")),
        "invalid lastModified": bad_instant(get("lastModified", "variant"), F.col("modified")),
        "invalid fetched_at": (F.col("fetched_at") != "") & F.col("fetched").isNull(),
    }
    return out, told.unionByName(_findings(good, rules, F.col("id")))


def provider_mappings(spark: SparkSession, path: str) -> DataFrame:
    """One row for each repository, day and provider of a catalogue; none for an empty mapping, which has a null provider.

    ``locator`` says where a mapping stands in its file.
    """
    found, _ = envelopes(spark, path)
    items = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")
    rows = found.select("day", "file", "line", "fetched_at", "url", F.posexplode(items).alias("position", "row"))
    maps = F.try_variant_get("row", "$.inferenceProviderMapping", "array<variant>")
    rows = rows.select("*", F.try_variant_get("row", "$.id", "string").alias("hf_repo_id"), F.posexplode_outer(maps).alias("mapping_position", "m")).where("hf_repo_id is not null")
    get = lambda name: F.try_variant_get("m", f"$.{name}", "string")
    return rows.select(
        F.to_date("day").alias("snapshot_date"), instant(F.col("fetched_at")).alias("fetched_at"), F.col("fetched_at").alias("fetched_text"), "hf_repo_id", "mapping_position", get("provider").alias("provider"), get("providerId").alias("provider_model_id"),
        get("status").alias("status"), get("task").alias("task"), F.to_json("m").alias("raw_mapping_json"), F.col("url").alias("source_url"), "file", "line", "position",
        F.format_string("line[%d].body[%d].inferenceProviderMapping[%d]", "line", "position", "mapping_position").alias("locator"),
    )


def provider_findings(spark: SparkSession, path: str) -> DataFrame:
    """What is wrong with a provider catalogue, row by row."""
    found, bad = envelopes(spark, path)
    v = F.try_parse_json("body")
    found = found.withColumn("is_list", F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False)))
    rows = found.where("is_list").select("day", "file", "line", F.explode(F.try_variant_get(v, "$", "array<variant>")).alias("row"))
    rows = rows.withColumn("id", F.try_variant_get("row", "$.id", "string")).withColumn("maps", F.try_variant_get("row", "$.inferenceProviderMapping", "array<variant>"))
    each = rows.where("id is not null").select("day", "file", "line", "id", F.explode("maps").alias("m"))
    return (
        bad.unionByName(_findings(found, {"body is not a list": ~F.col("is_list")}))
        .unionByName(_findings(rows, {"row without an id": F.coalesce(F.col("id") == "", F.lit(True)), "no provider mapping": F.col("id").isNotNull() & F.col("maps").isNull()}, F.col("id")))
        .unionByName(_findings(each, {"malformed provider mapping": F.coalesce(F.try_variant_get("m", "$.provider", "string") == "", F.lit(True))}, F.col("id")))
    )


def _route_rows(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("d"))
    rows = docs.select(_day(F.col("file")).alias("day"), "file", F.posexplode(F.try_variant_get("d", "$.data", "array<variant>")).alias("position", "r"))
    return rows.withColumn("id", F.nullif(F.try_variant_get("r", "$.id", "string"), F.lit("")))


def routes(spark: SparkSession, path: str, told: DataFrame | None = None, leg: str = "openrouter_models") -> DataFrame:
    """Routes of the daily catalogue; a blank repository id is null, an alias is a route whose slug differs from its id.

    ``told``, the manifests, says when a day's catalogue was fetched.
    """
    rows = _route_rows(spark, path).where("id is not null")
    get = lambda name, kind="string": F.try_variant_get("r", f"$.{name}", kind)
    slug = F.coalesce(F.nullif(get("canonical_slug"), F.lit("")), F.col("id"))
    out = rows.select(
        F.to_date("day").alias("snapshot_date"),
        F.col("id").alias("model_id"),
        slug.alias("canonical_slug"),
        F.when(slug != F.col("id"), slug).alias("alias_target"),
        (slug != F.col("id")).alias("is_alias"),
        get("name").alias("name"),
        F.nullif(F.trim(get("hugging_face_id")), F.lit("")).alias("hugging_face_id"),
        F.split_part(F.col("id"), F.lit("/"), F.lit(1)).alias("provider_prefix"),
        instant_of(get("created", "variant")).alias("created_at"),
        get("context_length", "long").alias("context_length"),
        get("pricing.prompt").alias("pricing_prompt"),
        get("pricing.completion").alias("pricing_completion"),
        get("architecture.modality").alias("architecture_modality"),
        F.to_json("r").alias("raw_json"),
        "file",
        "position",
    )
    if told is None:
        return out.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    at = told.where(F.col("leg") == leg).select(F.col("day").alias("snapshot_date"), instant(F.col("fetched_at")).alias("fetched_at"))
    return out.join(at, "snapshot_date", "left")


def route_findings(spark: SparkSession, path: str) -> DataFrame:
    rows = _route_rows(spark, path).withColumn("line", F.lit(1))
    created = F.try_variant_get("r", "$.created", "variant")
    return _findings(rows, {"route without an id": F.col("id").isNull(), "invalid created": bad_instant(created, instant_of(created))}, F.col("id"))


def same_day_claims(spark: SparkSession, path: str) -> DataFrame:
    """Declarations of each day's catalogue: (snapshot_date, canonical_slug) to claims with their row and the file's hash."""
    sums = files(spark, path).select(_day(F.col("path")).alias("_day"), F.col("sha256").alias("sha256_file"))
    rows = _route_rows(spark, path).withColumn("slug", F.nullif(F.try_variant_get("r", "$.canonical_slug", "string"), F.lit(""))).where("slug is not null")
    rows = rows.join(sums, F.col("day") == F.col("_day"))
    claim = F.struct(F.col("position").alias("row_index"), F.coalesce(F.try_variant_get("r", "$.hugging_face_id", "string"), F.lit("")).alias("hf_repo_id"), "sha256_file")
    return rows.groupBy(F.to_date("day").alias("snapshot_date"), F.col("slug").alias("canonical_slug")).agg(F.array_sort(F.collect_list(claim)).alias("claims"))


META = "id string, created string, updated string, title string, abstract string, categories string, doi string, `journal-ref` string, authors struct<author:array<struct<keyname:string,forenames:string>>>"
RECORD = f"header struct<_status:string,identifier:string,datestamp:string>, metadata struct<arXiv:struct<{','.join(':'.join(x.split(' ', 1)) for x in META.split(', '))}>>"


def papers(spark: SparkSession, path: str, day: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of harvested XML pages, deleted ones included, which have no metadata; and findings. Each record is parsed once."""
    found, bad = envelopes(spark, path)
    found = found.withColumn("xml", records(F.try_to_binary("body_base64", F.lit("base64")), "record"))
    rows = found.select("day", "file", "line", "fetched_at", "url", F.explode("xml").alias("x")).withColumn("r", F.from_xml("x", RECORD, {"mode": "PERMISSIVE"}))
    m = lambda name: F.nullif(F.trim(F.col(f"r.metadata.arXiv.`{name}`")), F.lit(""))
    names = F.transform("r.metadata.arXiv.authors.author", lambda a: F.concat_ws(" ", F.nullif(a["forenames"], F.lit("")), F.nullif(a["keyname"], F.lit(""))))
    listed = F.filter(F.split(F.coalesce(m("categories"), F.lit("")), r"\s+"), lambda x: x != "")
    rows = rows.withColumns({
        "arxiv_id": paper_id(F.regexp_replace("r.header.identifier", "^oai:arXiv.org:", "")), "deleted": F.coalesce(F.col("r.header._status") == "deleted", F.lit(False)),
        "categories": listed, "has_metadata": F.col("r.metadata.arXiv").isNotNull(), "created": instant(m("created")), "updated": instant(m("updated")), "datestamp": F.nullif(F.col("r.header.datestamp"), F.lit("")),
    })
    told = bad.unionByName(_findings(found, {"invalid XML page": F.col("xml").isNull()}))
    told = told.unionByName(_findings(rows, {"invalid identifier": F.col("arxiv_id").isNull()}, F.col("r.header.identifier")))
    known = rows.where("arxiv_id is not null")
    told = told.unionByName(_findings(known, {"missing metadata": ~F.col("has_metadata") & ~F.col("deleted")}, F.col("arxiv_id")))
    good = known.where("has_metadata or deleted")
    told = told.unionByName(_findings(good, {
        "no categories": ~F.col("deleted") & (F.size("categories") == 0),
        "invalid category": F.exists("categories", lambda x: ~x.rlike(f"^{CATEGORY}$")),
        "missing datestamp": F.col("datestamp").isNull(),
        "invalid date": (m("created").isNotNull() & F.col("created").isNull()) | (m("updated").isNotNull() & F.col("updated").isNull()) | (F.col("datestamp").isNotNull() & instant(F.col("datestamp")).isNull()),
    }, F.col("arxiv_id")))
    out = good.select(
        (F.to_date("day") if day is None else day).alias("observed_date"), instant(F.col("fetched_at")).alias("fetched_at"), "arxiv_id", m("title").alias("title"), m("abstract").alias("abstract"),
        F.coalesce(names, F.array().cast("array<string>")).alias("authors"), F.col("created").alias("submitted_at"), F.col("updated").alias("updated_at"), F.col("datestamp").alias("oai_datestamp"), "categories",
        F.try_element_at("categories", F.lit(1)).alias("primary_category"), m("doi").alias("doi"), m("journal-ref").alias("journal_ref"), "deleted", F.lit("oai").alias("metadata_source"), F.col("url").alias("source_url"), "file", "line",
    )
    return out, told


ITEM = "struct<status:string,response_file:string,sha256_raw:string,fetched_at:string,request_url:string,source_interface:string,error:string,original_references:array<string>>"
ENTRY = "id string, title string, summary string, published string, updated string, doi string, journal_ref string, author array<struct<name:string>>, category array<struct<_term:string>>, primary_category struct<_term:string>"


def enrichment(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Looked-up papers of a folder of feeds and its manifest: papers, the status of every id, and findings.

    Of entries of one id the last by file name and position counts; a paper is given only where its lookup is ``resolved``.
    """
    told = hidden_texts(spark, root, "_manifest.json", folders=False)
    items = told.select(F.explode(F.from_json("value", f"items map<string,{ITEM}>")["items"]).alias("arxiv_id", "i")).select("arxiv_id", "i.*")
    wanted = items.where(F.col("status").isin("resolved", "not_found")).select(F.col("response_file").alias("name")).distinct()
    name = F.substring_index("file", "/", -1)
    sums = inflated(spark, f"{root}/*.gz", "digests").select(name.alias("name"), "sha256_raw").join(wanted, "name", "left_semi")
    cut = inflated(spark, f"{root}/*.gz", "elements", tag="entry", root="feed").withColumn("name", name).join(sums, "name")
    broken = cut.where("error is not null").select("name", "error")
    rows = cut.join(broken.select("name").distinct(), "name", "left_anti").select("name", "sha256_raw", "position", F.col("xml").alias("x")).withColumn("e", F.from_xml("x", ENTRY))
    rows = rows.withColumn("arxiv_id", paper_id(F.regexp_replace(F.parse_url(F.trim("e.id"), F.lit("PATH")), "^/abs/", "")))
    last = rows.where("arxiv_id is not null").groupBy("arxiv_id").agg(F.max_by(F.struct("name", "sha256_raw", "e"), F.struct("name", "position")).alias("f"))
    both = items.where("status = 'resolved'").withColumnRenamed("sha256_raw", "told_sha256").join(last, "arxiv_id", "left")
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    terms = F.filter(F.transform("f.e.category", lambda c: c["_term"]), lambda x: x.isNotNull())
    papers_of = both.where("f is not null").select(
        F.to_date(F.substring("fetched_at", 1, 10)).alias("observed_date"), instant(F.col("fetched_at")).alias("fetched_at"), "arxiv_id", text("f.e.title").alias("title"), text("f.e.summary").alias("abstract"),
        F.filter(F.transform("f.e.author", lambda a: a["name"]), lambda x: x.isNotNull()).alias("authors"), instant(text("f.e.published")).alias("submitted_at"), instant(text("f.e.updated")).alias("updated_at"),
        terms.alias("categories"), F.col("f.e.primary_category._term").alias("primary_category"), text("f.e.doi").alias("doi"), text("f.e.journal_ref").alias("journal_ref"), F.lit(False).alias("deleted"),
        F.lit("atom").alias("metadata_source"), F.col("request_url").alias("source_url"), F.col("f.name").alias("file"),
    )
    statuses = items.select("arxiv_id", F.coalesce("original_references", F.array().cast("array<string>")).alias("original_references"), F.col("status").alias("resolution_status"), "source_interface", "fetched_at", F.col("request_url").alias("source_url"), "response_file", "sha256_raw", "error")
    flaws = both.select("arxiv_id", F.when(F.col("f").isNull(), "resolved but absent from the stored response").when(F.col("f.sha256_raw") != F.col("told_sha256"), "response hash mismatch").alias("error")).where("error is not null")
    flaws = flaws.unionByName(broken.select(F.col("name").alias("arxiv_id"), F.lit("not a feed").alias("error")))
    flaws = flaws.unionByName(rows.where("arxiv_id is null").select(F.col("e.id").alias("arxiv_id"), F.lit("invalid entry id").alias("error")))
    return papers_of, statuses, flaws


def backfill(spark: SparkSession, root: str, name: str = "arxiv.jsonl.gz") -> tuple[DataFrame, DataFrame]:
    """Papers of backfills that ended ``ok``, under the true day of their collection; and findings."""
    told = hidden_texts(spark, root, "_manifest.json").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("run"), F.from_json("value", "collected_at string, leg struct<status:string>").alias("m"))
    fine = told.where("m.leg.status = 'ok'").select("run", F.to_date(F.substring("m.collected_at", 1, 10)).alias("collected"))
    rows, flaws = papers(spark, f"{root}/*/{name}")
    run = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    out = rows.withColumn("run", run).join(fine, "run").withColumn("observed_date", F.col("collected")).drop("run", "collected")
    return out, flaws.withColumn("run", run).join(fine, "run", "left_semi").drop("run")


def strata(spark: SparkSession, path: str) -> DataFrame:
    """Paged catalogue results, one row an owner and name: the first by file, line and position."""
    rows = lines(spark, path).where(F.trim("value") != "")
    item = F.posexplode(F.try_variant_get(F.try_parse_json("value"), "$.body.results", "array<variant>")).alias("position", "r")
    rows = rows.select("file", "line", item)
    get = lambda name, kind="string": F.try_variant_get("r", f"$.{name}", kind)
    rows = rows.select(F.concat(get("owner"), F.lit("/"), get("name")).alias("key"), F.struct("file", "line", "position").alias("at"), get("run_count", "long").alias("run_count"), get("weights_url").alias("weights_url"), get("github_url").alias("github_url"), get("paper_url").alias("paper_url"), F.to_json("r").alias("raw_json"))
    first = rows.where("key is not null").groupBy("key").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("key", "at")]), "at").alias("f"))
    return first.select("key", "f.*")


def extract(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV extract with a header, under a given schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path, size_bytes, sha256_file, bytes_raw, sha256_raw of stored files; hashes are of bytes, never of decoded text, and run along with the blocks."""
    return inflated(spark, path, "digests").withColumnRenamed("file", "path")


def payload_index(spark: SparkSession, root: str, leg: str = "*") -> DataFrame:
    """One row a stored payload of the daily folders: hashes, counts, capture interval and precision, scope, statuses, and its snapshot id.

    A payload whose hash isn't the manifest's is ``mismatch``; where the manifest has none it is ``unattested``. Envelopes are
    counted line by line; only a document that is one JSON value is looked at as a whole.
    """
    source = lambda c: F.split_part(F.substring_index(c, "/", -1), F.lit("."), F.lit(1))
    found = digests(spark, f"{root}/*/{leg}.gz").withColumns({"day": _day(F.col("path")), "source": source("path"), "is_lines": F.col("path").endswith(".jsonl.gz")})
    found = found.withColumn("snapshot_path", F.concat("day", F.lit("/"), F.substring_index("path", "/", -1)))
    size = lambda c: F.coalesce(F.json_array_length(c), F.lit(0))
    told = lines(spark, f"{root}/*/{leg}.gz").withColumn("source", source("file"))
    e = F.from_json("value", "fetched_at string, body string, records array<string>")
    rows = told.where(F.col("file").endswith(".jsonl.gz") & (F.trim("value") != "")).withColumn("e", e)
    records = F.when(F.col("source").isin(*DETAIL), 1).when(F.col("source") == "arxiv", F.greatest(F.size(F.coalesce("e.records", F.array().cast("array<string>"))), F.lit(0))).otherwise(size("e.body"))
    stamp = F.col("e.fetched_at")
    at = lambda: F.struct(stamp.try_cast("timestamp").alias("at"), stamp.alias("text"))
    counts = rows.groupBy(F.col("file").alias("_file")).agg(F.count("*").alias("n_envelopes"), F.sum(records).alias("n_records"), F.count(stamp).alias("n_stamps"), F.min(F.when(stamp.isNotNull(), at())).alias("first_stamp"), F.max(F.when(stamp.isNotNull(), at())).alias("last_stamp"))
    catalogue = told.where((F.col("source") == "openrouter_models") & ~F.col("file").endswith(".jsonl.gz"))
    catalogue = catalogue.groupBy(F.col("file").alias("_document")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("text"))
    catalogue = catalogue.select("_document", F.json_array_length(F.get_json_object("text", "$.data")).alias("n_listed"))
    found = found.join(counts, F.col("path") == F.col("_file"), "left").join(catalogue, F.col("path") == F.col("_document"), "left")
    found = found.withColumns({"response_count": F.when(F.col("is_lines"), F.coalesce("n_envelopes", F.lit(0))).otherwise(1), "source_record_count": F.when(F.col("is_lines"), F.coalesce("n_records", F.lit(0))).otherwise(F.col("n_listed"))})
    docs = hidden_texts(spark, root, "_manifest.json").select(_day(F.col("path")).alias("_day"), F.sha2("value", 256).alias("manifest_sha256_file"), F.from_json("value", f"status string, snapshot_date string, collected_at string, collector_version string, legs map<string,{LEG}>").alias("m"))
    both = found.join(docs, F.col("day") == F.col("_day"), "left").withColumn("l", F.try_element_at("m.legs", F.col("source")))
    enveloped = F.coalesce(F.col("n_stamps") > 0, F.lit(False))
    of_leg = ~F.col("is_lines") & F.col("l.fetched_at").isNotNull()
    basis = F.when(enveloped, "response_envelope.fetched_at").when(of_leg, "manifest.legs.fetched_at").when(F.col("m.collected_at").isNotNull(), "manifest.collected_at").when(F.col("m.snapshot_date").isNotNull(), "manifest.snapshot_date").otherwise("unknown")
    one = F.when(of_leg, F.col("l.fetched_at")).otherwise(F.col("m.collected_at"))
    single = F.when(one.isNotNull(), F.struct(one.try_cast("timestamp").alias("at"), one.alias("text")))
    both = both.withColumns({"basis": basis, "first": F.when(enveloped, F.col("first_stamp")).otherwise(single), "last": F.when(enveloped, F.col("last_stamp")).otherwise(single), "n_times": F.when(enveloped, F.col("n_stamps")).otherwise(F.when(one.isNotNull(), 1).otherwise(0))})
    state = F.when(F.col("l.sha256_raw").isNull(), "unattested").when(F.col("l.sha256_raw") == F.col("sha256_raw"), "verified").otherwise("mismatch")
    return both.select(
        F.sha2(F.concat("snapshot_path", F.lit("\n"), "sha256_file"), 256).alias("snapshot_id"), "source", F.to_json(F.struct("l.scope", "l.filter", "l.sort", "l.target_rows")).alias("source_scope"), "snapshot_path",
        "manifest_sha256_file", F.to_date("m.snapshot_date").alias("collection_day"), observation_date(F.col("first.at"), F.to_date("m.snapshot_date")).alias("collection_date"), F.col("first.at").alias("collected_at"), F.col("last.at").alias("collected_until"),
        F.col("basis").alias("observed_basis"), F.coalesce(precision(F.col("first.text")), F.when(F.col("m.snapshot_date").isNotNull(), "day")).alias("observed_precision"), F.col("n_times").alias("capture_timestamp_count"), "response_count",
        F.when(F.col("source") != "arxiv", F.col("source_record_count")).alias("model_observation_count"), "source_record_count", "sha256_file", "sha256_raw", F.col("l.sha256_raw").alias("manifest_sha256_raw"), state.alias("integrity_status"), "size_bytes", "bytes_raw",
        F.col("m.collector_version").alias("collector_version"), F.col("m.status").alias("run_status"), F.col("l.status").alias("leg_status"), F.col("l.pagination_complete").alias("pagination_complete"), F.col("l.url").alias("leg_url"), F.col("l.fetched_at").alias("leg_fetched_at"), F.lit(False).alias("can_confirm_absence"),
    )


def deployment_facts(spark: SparkSession, root: str, index: DataFrame) -> DataFrame:
    """Positive provider facts of the route and the provider catalogue, each with its locator, price, context and capabilities."""
    known = index.select("snapshot_id", "source", "snapshot_path", "source_scope", "collection_day", "observed_basis", "sha256_file", "leg_fetched_at", "leg_url")
    at = lambda c: F.concat(_day(F.col(c)), F.lit("/"), F.substring_index(c, "/", -1)).alias("snapshot_path")
    r = routes(spark, f"{root}/*/openrouter_models.json.gz").select(at("file"), F.lit("openrouter").alias("provider"), F.col("model_id").alias("provider_model_id"), F.format_string("data[%d]", "position").alias("locator"), F.try_parse_json("raw_json").alias("raw"), F.col("hugging_face_id").alias("source_hf_repo_id"), F.lit(None).cast("string").alias("observed_text"), F.lit(None).cast("string").alias("row_url"))
    p = provider_mappings(spark, f"{root}/*/hf_inference_providers.jsonl.gz").where("provider is not null").select(at("file"), "provider", "provider_model_id", "locator", F.try_parse_json("raw_mapping_json").alias("raw"), F.col("hf_repo_id").alias("source_hf_repo_id"), F.col("fetched_text").alias("observed_text"), F.col("source_url").alias("row_url"))
    rows = r.unionByName(p).join(known, "snapshot_path")
    router = F.col("source") == "openrouter_models"
    get = lambda a, b, kind="variant": F.when(router, F.try_variant_get("raw", f"$.{a}", kind)).otherwise(F.try_variant_get("raw", f"$.{b}", kind))
    rows = rows.withColumn("told", F.when(router, F.col("leg_fetched_at")).otherwise(F.col("observed_text"))).withColumn("observed_at", instant(F.col("told")))
    named = F.trim("provider_model_id") != ""
    key = F.sha2(F.to_json(F.array(F.lit("provider_deployment/1"), "provider", "provider_model_id")), 256)
    row_sum = F.sha2(F.to_json("raw"), 256)
    limits = F.struct(get("context_length", "providerDetails.context_length", "long").alias("context_length"), get("top_provider.max_completion_tokens", "providerDetails.max_completion_tokens", "long").alias("max_completion_tokens"), F.when(router, "context_length").otherwise("providerDetails.context_length").alias("source_field"))
    only = lambda cond, path, kind="variant": F.when(cond, F.try_variant_get("raw", f"$.{path}", kind))
    able = F.to_json(F.struct(only(router, "architecture").alias("architecture"), only(~router, "features").alias("features"), only(router, "supported_parameters").alias("supported_parameters"), only(~router, "task").alias("task")))
    return rows.select(
        F.sha2(F.to_json(F.array(F.lit("deployment_observation/1"), "snapshot_id", "provider", "provider_model_id", "locator", row_sum)), 256).alias("observation_id"),
        F.when(named, key).alias("deployment_key"), "snapshot_id", "provider", "provider_model_id", F.when(named, "identified").otherwise("missing_provider_model_id").alias("deployment_id_status"), "observed_at",
        observation_date(F.col("observed_at"), F.col("collection_day")).alias("observation_date"), F.coalesce(precision(F.col("told")), F.when(F.col("collection_day").isNotNull(), "day")).alias("observed_precision"),
        F.when(router, F.col("observed_basis")).when(F.col("observed_at").isNotNull(), "response_envelope.fetched_at").otherwise("manifest.snapshot_date").alias("observed_basis"), F.lit("PRESENT").alias("presence_state"), only(~router, "status", "string").alias("provider_status"),
        F.to_json(get("pricing", "providerDetails.pricing")).alias("price_json"), F.when(router, "pricing").otherwise("providerDetails.pricing").alias("price_field"), limits.alias("context"), able.alias("capabilities_json"), "source", "source_scope", "source_hf_repo_id",
        F.when(router & named, F.split_part("provider_model_id", F.lit("/"), F.lit(1))).alias("source_publisher"), only(router, "canonical_slug", "string").alias("source_canonical_slug"), "snapshot_path", "sha256_file", "locator", row_sum.alias("source_row_sha256"), F.when(router, F.col("leg_url")).otherwise(F.col("row_url")).alias("source_url"), "collection_day",
    )


def hidden_texts(spark: SparkSession, root: str, name: str, folders: bool = True) -> DataFrame:
    """(path, value) of a file of this name in every day's folder, or in the folder itself. Spark's readers skip names that begin
    with an underscore, so the driver lists the days, one path each, and tasks read the files."""
    importable(spark)
    store, top = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    days = [x.path for x in store.get_file_info(fs.FileSelector(top)) if x.type == fs.FileType.Directory] if folders else [top]
    paths = spark.createDataFrame([(f"{d}/{name}",) for d in sorted(days)], "path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            there = [p for p, x in zip(b.column(0).to_pylist(), store_of(root).get_file_info(b.column(0).to_pylist())) if x.type == fs.FileType.File]
            texts = []
            for p in there:
                with store_of(root).open_input_stream(p) as f:
                    texts.append(f.read().decode())
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.string()), pa.array(texts, pa.string())], ["path", "value"])

    return paths.repartition(min(max(1, len(days)), 200)).mapInArrow(run, "path string, value string")


def store_of(root: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")[0]


def manifests(spark: SparkSession, root: str, name: str = "_manifest.json") -> DataFrame:
    """One row for each day and leg."""
    docs = hidden_texts(spark, root, name).select(_day(F.col("path")).alias("day"), F.from_json("value", f"status string, legs map<string,{LEG}>").alias("m"))
    rows = docs.select(F.to_date("day").alias("day"), F.col("m.status").alias("day_status"), F.explode("m.legs").alias("leg", "l"))
    return rows.select("day", "day_status", "leg", "l.*")


def admitted(rows: DataFrame, told: DataFrame, leg: str, day: str = "snapshot_date", partial: tuple[str, ...] = ("hf_cohort",)) -> DataFrame:
    """Rows of days whose manifest has the leg as ``ok``, or as ``partial`` where that is enough."""
    fine = (F.col("status") == "ok") | ((F.col("status") == "partial") & F.lit(leg in partial))
    days = told.where((F.col("leg") == leg) & fine).select(F.col("day").alias("_day")).distinct()
    return rows.join(days, rows[day] == F.col("_day"), "left_semi")


def files(spark: SparkSession, path: str) -> DataFrame:
    """Inventory: path, size and SHA-256 of every stored file."""
    return digests(spark, path).select("path", F.col("size_bytes").alias("size"), F.col("sha256_file").alias("sha256"))


def integrity(spark: SparkSession, path: str, told: DataFrame) -> DataFrame:
    """Legs whose stored size or raw hash isn't what the manifest says."""
    stored = digests(spark, path).select(F.to_date(_day(F.col("path"))).alias("day"), F.substring_index("path", "/", -1).alias("file"), "size_bytes", F.col("sha256_raw").alias("raw"))
    joined = told.join(stored, ["day", "file"], "left")
    problem = F.when(F.col("size_bytes").isNull(), "missing").when(F.col("size_bytes") != F.col("bytes_stored"), "size").when(F.col("raw") != F.col("sha256_raw"), "hash")
    return joined.withColumn("problem", problem).where("problem is not null").select("day", "leg", "file", "problem")


def archive_totals(spark: SparkSession, root: str, name: str = "*/*.gz") -> DataFrame:
    """Files, bytes, and the first and last capture that the manifests tell with an offset: capture bounds, not dates of effect."""
    sums = spark.read.format("binaryFile").load(f"{root}/{name}").agg(F.count("*").alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    stamp = F.explode(F.regexp_extract_all("value", F.lit(r'"(?:fetched_at|collected_at)"\s*:\s*"([^"]*)"'), F.lit(1)))
    times = hidden_texts(spark, root, "_manifest.json").select(stamp.alias("t")).select(strict_instant(F.col("t")).alias("at"))
    bounds = times.agg(F.min("at").alias("min_timestamp"), F.max("at").alias("max_timestamp"))
    return sums.join(F.broadcast(bounds))


def acknowledgements(spark: SparkSession, path: str, with_leg: bool) -> DataFrame:
    """Lines ``day reason`` or ``day leg reason``; comments and blank lines don't count."""
    rows = spark.read.text(path).where(F.trim("value").rlike(r"^\d{4}-\d{2}-\d{2}\s"))
    pattern = r"^(\S+)\s+(\S+)\s+(.*)$" if with_leg else r"^(\S+)\s+(.*)$"
    part = lambda i: F.regexp_extract(F.trim("value"), pattern, i)
    out = [F.to_date(part(1)).alias("day")] + ([part(2).alias("leg"), part(3).alias("reason")] if with_leg else [part(2).alias("reason")])
    return rows.select(*out)
