"""Revisioned usage exports, share series and ledgers; and the sinks of tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .inflate import located

ROWS = "array<struct<date:string,`group`:string,modality:string,name:string,metric:string,share_percent:variant>>"
TOKENS = "array<struct<date:string,model_permaslug:string,model_name:string,total_tokens:variant>>"
MANIFEST = "source string, start_date string, end_date string, fetched_at string, sha256 string, url string"
METRICS = ["requests", "tokens", "spend"]


def revisions(spark: SparkSession, root: str) -> DataFrame:
    """Manifest and body of every stored revision, ``ok`` where the hash of the body's bytes is the manifest's."""
    folder = lambda c: F.regexp_extract(c, r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1).alias("folder")
    told = spark.read.text(f"{root}/*/*/*/manifest.json", wholetext=True).select(folder(F.col("_metadata.file_path")), F.from_json("value", MANIFEST).alias("m")).select("folder", "m.*")
    body = spark.read.format("binaryFile").load(f"{root}/*/*/*/response.json").select(folder(F.col("path")), F.sha2("content", 256).alias("_sum"), F.decode("content", "UTF-8").alias("body"))
    return told.join(body, "folder").withColumn("ok", F.col("_sum") == F.col("sha256")).drop("_sum")


def usage_rows(found: DataFrame) -> DataFrame:
    """Long usage rows: metric, unit, whether it is the remainder, and a value that is null where it isn't valid.

    Tokens are whole numbers, or text of digits; shares are numbers from 0 to 100. ``in_range`` says whether the day is of the
    request, ``in_scope`` whether a share is of models and of text. The remainder has no source id.
    """
    kept = ["source", "fetched_at", "folder", "sha256", "start_date", "end_date"]
    number = lambda v: F.when(~F.schema_of_variant(v).isin("STRING", "BOOLEAN", "VOID"), F.try_variant_get(v, "$", "double"))
    share = F.from_json("body", f"rows {ROWS}")["rows"]
    token = F.from_json("body", f"data {TOKENS}")["data"]
    as_of = F.get_json_object("body", "$.meta.as_of").alias("as_of")
    a = found.where("ok").select(*kept, as_of, F.explode(share).alias("r")).withColumn("n", number(F.col("r.share_percent")))
    fine = F.col("n").between(0, 100) & ~F.isnan("n")
    a = a.select(*kept, "as_of", F.to_date("r.date").alias("day"), F.col("r.name").alias("name"), F.lit(None).cast("string").alias("source_id"), F.col("r.metric").alias("metric"), F.lit("percent").alias("unit"), F.when(fine, F.col("n")).alias("value"), F.coalesce((F.col("r.group") == "model") & (F.col("r.modality") == "text") & F.col("r.metric").isin(METRICS), F.lit(False)).alias("in_scope"))
    b = found.where("ok").select(*kept, as_of, F.explode(token).alias("r"))
    kind, text = F.schema_of_variant("r.total_tokens"), F.try_variant_get("r.total_tokens", "$", "string")
    whole = F.when((kind == "BIGINT") | ((kind == "STRING") & text.rlike("^[0-9]+$")) | (kind.startswith("DECIMAL") & kind.endswith(",0)")), text.try_cast("double"))
    b = b.select(*kept, "as_of", F.to_date("r.date").alias("day"), F.coalesce(F.nullif("r.model_name", F.lit("")), "r.model_permaslug").alias("name"), F.col("r.model_permaslug").alias("source_id"), F.lit("tokens").alias("metric"), F.lit("tokens").alias("unit"), F.when(whole >= 0, whole).alias("value"), F.lit(True).alias("in_scope"))
    both = a.unionByName(b)
    other = F.coalesce(F.lower("name") == "other", F.lit(False)) | F.coalesce(F.col("source_id") == "other", F.lit(False))
    both = both.withColumns({"is_other": other, "in_range": F.coalesce(F.col("day").between(F.to_date("start_date"), F.to_date("end_date")), F.lit(False)), "key": F.coalesce("source_id", "name")})
    return both.withColumn("source_id", F.when(~F.col("is_other"), F.col("source_id"))).withColumn("identity_status", F.when(F.col("is_other"), "aggregate").otherwise("unresolved"))


def expected_days(found: DataFrame, metrics: DataFrame) -> DataFrame:
    """(source, day, metric) that stored revisions asked for; ``metrics`` has the metrics of each source."""
    days = found.select("source", F.explode(F.sequence(F.to_date("start_date"), F.to_date("end_date"), F.expr("interval 1 day"))).alias("day")).distinct()
    return days.join(metrics, "source")


def share_series(spark: SparkSession, path: str) -> DataFrame:
    """Share arrays by name to long rows, with the length of each array and of the timestamps; entries beyond either have null for the other."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", "result struct<serie_0:map<string,array<string>>>").alias("d"))
    rows = docs.select("file", F.col("d.result.serie_0").alias("s")).select("file", F.col("s")["timestamps"].alias("ts"), F.explode(F.map_filter("s", lambda k, v: k != "timestamps")).alias("name", "shares"))
    zipped = rows.select("file", "name", F.size("ts").alias("n_timestamps"), F.size("shares").alias("n_shares"), F.posexplode(F.arrays_zip("ts", "shares")).alias("position", "z"))
    return zipped.where("z.ts is not null").select("file", "name", "position", F.to_date(F.substring("z.ts", 1, 10)).alias("day"), F.col("z.shares").try_cast("double").alias("share"), "n_timestamps", "n_shares")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, source_model_id string, source_name string, hf_repo_id string, valid_from date, valid_until date, reviewer string, evidence_url string").json(path, multiLine=True)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """One row a member of a cohort registry; who isn't said to be inactive is active, and enrolled when the cohort was selected."""
    docs = spark.read.schema("cohort_id string, selected_at string, members array<struct<hf_repo_id:string,selection_group:string,active:boolean,enrolled_at:string>>").json(path, multiLine=True)
    rows = docs.select("cohort_id", "selected_at", F.explode("members").alias("m")).select("cohort_id", "selected_at", "m.*")
    return rows.withColumns({"active": F.coalesce("active", F.lit(True)), "enrolled_at": F.coalesce("enrolled_at", "selected_at")})


def new_occurrences(store: DataFrame) -> DataFrame:
    """Revisions whose body differs from the one before of the same export; a return to an older body is kept."""
    w = Window.partitionBy("url", "start_date", "end_date").orderBy("fetched_at", "folder")
    return store.withColumn("_p", F.lag("sha256").over(w)).where(~F.col("_p").eqNullSafe(F.col("sha256"))).drop("_p")


def write_table(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None, files: int | None = None) -> None:
    """Parquet with fixed columns in fixed order, zstd; with ``order`` the files in order of their names are the sorted table.

    Ranges are cut where a sketch of the keys says, and rows of one key are told apart by their hash and equal rows by their
    place in the input, so that a key with many rows fills several files. ``files`` is their number, the shuffle setting if not given.
    """
    out = df.select(*columns)
    if order:
        n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tie = {"_h": F.xxhash64(*[F.col(f"`{c}`") for c in columns]), "_i": F.pmod(F.monotonically_increasing_id(), F.lit(1024))}
        keys = [*[F.col(f"`{c}`") if isinstance(c, str) else c for c in order], "_h", "_i"]
        out = out.withColumns(tie).repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(*columns)
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_typed(df: DataFrame, path: str, schema: str, order: list[str] | None = None) -> None:
    """As ``write_table``, under a schema that is stated: every column must be there, and is cast to its type.

    A value that its type can't hold fails the write instead of becoming null; further columns are an error, so that a table never grows by accident.
    """
    fields = StructType.fromDDL(schema)
    if extra := set(df.columns) - set(fields.names):
        raise ValueError(f"columns that the schema lacks: {sorted(extra)}")
    typed = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    write_table(typed, path, fields.names, order)


def write_report(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One JSON document in one file: a list of the rows, in ``order``; or the row itself as an object where there is no order.

    A report is a summary; its rows still pass the driver one partition at a time and are never held together. A name shows up
    only once its file is whole.
    """
    store, inner, _ = located(path)
    text = df.select(*df.columns, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("_json"))
    rows = (r[0] for r in (text.orderBy(*order) if order else text).select("_json").toLocalIterator())
    store.create_dir(inner.rsplit("/", 1)[0])
    with store.open_output_stream(f"{inner}.part") as f:
        if order is None:
            first = next(rows, None)
            if first is None or next(rows, None) is not None:
                raise ValueError("a report without an order is of one row")
            f.write(first.encode() + b"\n")
        else:
            f.write(b"[")
            for i, row in enumerate(rows):
                f.write((",\n" if i else "\n").encode() + row.encode())
            f.write(b"\n]\n")
    store.move(f"{inner}.part", inner)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sample_of_errors(found: DataFrame, order: list[str], most: int = 100) -> DataFrame:
    """The first findings in a stable order, each with the full count, as a report shows them."""
    total = found.agg(F.count("*").alias("n_all"))
    return found.orderBy(*order).limit(most).join(F.broadcast(total))
