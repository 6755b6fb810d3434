"""Scalar expressions: parsing, normalising and labelling, without a UDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = r"(Z|[+-]\d\d:?\d\d)$"
# Forms of paper ids, of repository ids, and the statuses after which a day asks no more.
PAPER = r"(?i)^([a-z-]+(\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(v\d+)?$"
REPO = r"^[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)*(/[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)*)?$"
PERMANENT = [401, 403, 404, 410, 451]
# Hosts whose paths name a repository, and the sections of them that don't.
REPO_HOSTS = ["huggingface.co", "www.huggingface.co"]
SECTIONS = ["datasets", "spaces", "collections", "papers"]
#: Exponents beyond which a decimal is kept as digits and exponent.
WIDEST = 1000


def instant(text: Column) -> Column:
    """ISO-8601 text as a timestamp; null, empty and bad text is null. Digits alone are a date, never an epoch."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return F.coalesce(iso, F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))))


def epoch(seconds: Column) -> Column:
    """Numbers are seconds since 1970."""
    return F.timestamp_seconds(seconds.try_cast("double"))


def instant_of(value: Column) -> Column:
    """A JSON value as a timestamp: numbers are epochs, text is ISO-8601, all else is null."""
    kind = F.schema_of_variant(value)
    number = F.when(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), epoch(F.try_variant_get(value, "$", "double")))
    return F.coalesce(number, F.when(kind == "STRING", instant(F.try_variant_get(value, "$", "string"))))


def bad_instant(value: Column, at: Column) -> Column:
    """Whether a JSON value that is there and not empty gave no timestamp."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(text.isNotNull() & (text != "") & at.isNull(), F.lit(False))


def strict_instant(value: Column) -> Column:
    """As ``instant``, but text without an offset is null."""
    return F.when(value.rlike(OFFSET), value.try_cast("timestamp"))


def precision(value: Column) -> Column:
    digits = F.regexp_extract(value, r"\.(\d+)", 1)
    return F.when(F.length(digits) > 0, F.concat(F.lit("fractional_seconds_"), F.length(digits))).when(value.contains("T") | value.contains(":"), "second").otherwise("day")


def paper_id(value: Column) -> Column:
    """Canonical paper id, of the modern or the archive/number form: trimmed, without prefix and version; null if it isn't one."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"^\s+|\s+$", ""), "^arXiv:", ""), "^arxiv:", "")
    return F.when(bare.rlike(PAPER), F.regexp_replace(bare, r"(?i)v\d+$", ""))


def valid_paper_id(identifier: Column) -> Column:
    """Whether an id without version can have been given out: a month from April 2007 on and a number above zero; old ids need the latter."""
    modern = identifier.rlike(r"^\d{4}\.\d{4,5}$")
    year, month = F.substring(identifier, 1, 2).try_cast("int"), F.substring(identifier, 3, 2).try_cast("int")
    number = F.regexp_extract(identifier, r"(\d+)$", 1).try_cast("int")
    since = (year > 7) | ((year == 7) & (month >= 4))
    old = identifier.contains("/") & identifier.rlike(r"/\d+$") & (number > 0)
    fine = F.when(modern, month.between(1, 12) & (number > 0) & since).otherwise(old)
    return F.coalesce(paper_id(identifier).isNotNull() & fine, F.lit(False))


def paper_ids(tags: Column) -> Column:
    """Sorted distinct canonical ids among tags."""
    found = F.transform(F.filter(tags, lambda x: x.rlike("(?i)^arxiv:.")), lambda x: paper_id(F.substr(x, F.lit(7))))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))


def base_model(tags: Column) -> Column:
    """What follows ``base_model:`` in the first such tag that isn't a finetune's."""
    hit = F.filter(tags, lambda x: x.startswith("base_model:") & ~x.startswith("base_model:finetune:"))
    return F.substr(F.try_element_at(hit, F.lit(1)), F.lit(len("base_model:") + 1))


def author(given: Column, repo: Column) -> Column:
    """The author, or where none is given what stands before the id's slash; an id without one is its own author."""
    return F.coalesce(F.nullif(given, F.lit("")), F.substring_index(repo, "/", 1))


def age_days(created: Column, seen: Column) -> Column:
    return F.date_diff(seen, F.to_date(F.substring(created, 1, 10)))


def primary(source: Column, age: Column, newest: str) -> Column:
    """First seen in the newest list at an age of 0 to 4 days; unknown is false."""
    return F.coalesce((source == newest) & age.between(0, 4), F.lit(False))


def observation_order(other: Column, first: Column) -> Column:
    """Where another source's first day stands to the first day of all."""
    return F.when(other.isNull(), "not_observed").when(other < first, "before_hf").when(other == first, "same_day").otherwise("after_hf")


def left_censored(day: Column, first: Column, earlier: bool = False) -> Column:
    """Whether a first day may be earlier than it looks: it is the first day of all, or with ``earlier`` before it."""
    return F.coalesce(day <= first if earlier else day == first, F.lit(False))


def valid_repo(identifier: Column) -> Column:
    return F.coalesce(identifier.rlike(REPO), F.lit(False))


def valid_counts(downloads: Column, likes: Column) -> Column:
    """Both are there and not negative."""
    return F.coalesce((downloads >= 0) & (likes >= 0), F.lit(False))


def eligible(repo: Column, downloads: Column, likes: Column, private: Column, disabled: Column) -> Column:
    """Whether a repository may be sampled: a valid id, valid counts, neither private nor disabled."""
    closed = F.coalesce(private, F.lit(False)) | F.coalesce(disabled, F.lit(False))
    return valid_repo(repo) & valid_counts(downloads, likes) & ~closed


def response_reason(wanted: Column, identifier: Column, model: Column, downloads: Column, likes: Column) -> Column:
    """Why a response is no observation of what was asked for; null if it is one."""
    other = F.coalesce(identifier != wanted, F.lit(False)) | F.coalesce(model != wanted, F.lit(False))
    nothing = identifier.isNull() & model.isNull()
    return F.when(other, "identity_mismatch").when(nothing | ~valid_counts(downloads, likes), "invalid_response")


def terminal_failure(status: Column, reason: Column, wanted: Column, response: Column, all_ids: Column, measured: Column, day: Column) -> Column:
    """Whether a failure settles the day: a permanent status, or an answer of the day whose ids are all the same other valid one."""
    same = F.forall(F.coalesce(all_ids, F.array().cast("array<string>")), lambda x: x.eqNullSafe(response))
    renamed = same & (status == 200) & (reason == "identity_mismatch") & valid_repo(response) & (response != wanted) & (F.to_date(measured) == day)
    return F.coalesce(status.isin(PERMANENT), F.lit(False)) | F.coalesce(renamed, F.lit(False))


def observation_date(at: Column, collected: Column) -> Column:
    """The UTC date of the instant, else the day of the collection."""
    return F.coalesce(F.to_date(at), collected)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is computed once however often it is used."""
    return F.try_element_at(F.transform(F.array(value), then), F.lit(1))


def plain_decimal(text: Column) -> Column:
    """A decimal number of any size as plain digits, without plus, exponent and needless zeros; null for other text.

    The point is moved in the digits themselves, so nothing is rounded; beyond ``WIDEST`` places it stays ``digits e exponent``,
    which is as good for telling whether two are equal.
    """
    form = r"^([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
    bare = F.translate(F.regexp_replace(text, r"^\s+|\s+$", ""), "_", "")
    part = lambda i: F.regexp_extract(bare, form, i)
    shape = F.when(bare.rlike(form) & bare.rlike(r"^[+-]?\.?[0-9]"), F.struct(part(1).alias("sign"), F.concat(part(2), part(3)).alias("digits"), F.length(part(2)).alias("whole"), F.nullif(part(4), F.lit("")).alias("exponent")))

    def placed(m: Column) -> Column:
        power = F.coalesce(m["exponent"], F.lit("0")).try_cast("long")
        lead = F.length(m["digits"]) - F.length(F.ltrim(m["digits"], F.lit("0")))
        return F.struct(m["sign"].alias("sign"), F.trim(m["digits"], F.lit("0")).alias("digits"), (m["whole"] + power - lead).alias("point"), power.alias("power"))

    def written(n: Column) -> Column:
        digits, point, size = n["digits"], n["point"], F.length(n["digits"])
        zeros = lambda k: F.repeat(F.lit("0"), k.cast("int"))
        plain = F.when(point >= size, F.concat(digits, zeros(point - size))).when(point > 0, F.concat(F.substr(digits, F.lit(1), point.cast("int")), F.lit("."), F.substr(digits, (point + 1).cast("int")))).otherwise(F.concat(F.lit("0."), zeros(-point), digits))
        number = F.when(F.abs(point) <= WIDEST, plain).otherwise(F.concat(digits, F.lit("e"), (point - size).cast("string")))
        return F.when(n["power"].isNull(), None).when(digits == "", "0").otherwise(F.concat(F.when(n["sign"] == "-", "-").otherwise(""), number))

    return let(shape, lambda m: F.when(m.isNotNull(), let(placed(m), written)))


def price(value: Column) -> Column:
    """A price as it is compared, (kind, value): equal decimals are equal however they are written, other text stays as it is."""
    told = let(plain_decimal(value), lambda n: F.struct(F.when(n.isNull(), "text").otherwise("decimal").alias("kind"), F.coalesce(n, value).alias("value")))
    return F.when(value.isNotNull(), told)


def price_of(value: Column) -> Column:
    """As ``price``, of a JSON value: booleans are apart from numbers, and what is neither keeps its type."""
    kind = F.schema_of_variant(value)
    text = F.when(kind.isin("BIGINT", "DOUBLE", "STRING") | kind.startswith("DECIMAL"), F.try_variant_get(value, "$", "string"))
    name = lambda n: F.when(kind == "BOOLEAN", "boolean").when(n.isNotNull(), "decimal").otherwise(F.lower(kind))
    told = let(plain_decimal(text), lambda n: F.struct(name(n).alias("kind"), F.coalesce(n, F.to_json(value)).alias("value")))
    return F.when(kind != "VOID", told)


def leaves(value: Column, depth: int = 12, unordered: bool = False) -> Column:
    """Leaves of a JSON object as a map of dotted path to JSON text; nulls are dropped, and with ``unordered`` arrays are sorted.

    An object that is nested deeper than ``depth`` fails the query, so that no result ever depends on the depth.
    """
    entries = lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    pair = lambda path, v: F.struct(path.alias("path"), v.alias("value"))
    found = F.transform(entries(value), lambda kv: pair(kv["key"], kv["value"]))
    for _ in range(depth - 1):
        inner = lambda e: F.transform(entries(e["value"]), lambda kv: pair(F.concat(e["path"], F.lit("."), kv["key"]), kv["value"]))
        found = F.flatten(F.transform(found, lambda e: F.when(F.schema_of_variant(e["value"]).startswith("OBJECT"), inner(e)).otherwise(F.array(pair(e["path"], e["value"])))))
    deep = F.exists(found, lambda e: F.coalesce(F.schema_of_variant(e["value"]).startswith("OBJECT"), F.lit(False)))
    found = F.when(~deep, found).when(deep, F.raise_error(F.lit(f"JSON is nested deeper than {depth} objects")).cast("array<struct<path:string,value:variant>>"))
    there = F.filter(found, lambda e: e["value"].isNotNull() & (F.schema_of_variant(e["value"]) != "VOID"))

    def text(v: Column) -> Column:
        if not unordered:
            return F.to_json(v)
        items = F.array_sort(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.to_json(x)))
        return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))).otherwise(F.to_json(v))

    out = F.map_from_entries(F.transform(there, lambda e: F.struct(e["path"], text(e["value"]))))
    return F.coalesce(out, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def content_key(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.array(*parts)), 256)


def changed_keys(a: Column, b: Column) -> Column:
    """Keys that both maps have with different values."""
    both = F.array_intersect(F.map_keys(a), F.map_keys(b))
    return F.array_sort(F.filter(both, lambda k: ~F.element_at(a, k).eqNullSafe(F.element_at(b, k))))


def repo_of(url: Column) -> Column:
    """Owner and name out of the path of a URL of a repository host; null for other hosts and for sections that hold no models."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    path = F.coalesce(F.try_url_decode(F.replace(part("PATH"), F.lit("+"), F.lit("%2B"))), part("PATH"))
    parts = F.split(F.trim(path, F.lit("/")), "/")
    fine = F.lower(part("HOST")).isin(REPO_HOSTS) & (F.size(parts) >= 2) & ~F.try_element_at(parts, F.lit(1)).isin(SECTIONS)
    return F.when(fine, F.array_join(F.slice(parts, 1, 2), "/"))


def paper_of(url: Column) -> Column:
    """The paper id in the path of a link to an abstract or a file; null for other hosts."""
    path = F.regexp_replace(F.regexp_replace(F.parse_url(url, F.lit("PATH")), r"^/(abs|pdf)/", ""), r"\.pdf$", "")
    return F.when(F.parse_url(url, F.lit("HOST")).isin("arxiv.org", "www.arxiv.org"), F.split_part(path, F.lit("v"), F.lit(1)))
