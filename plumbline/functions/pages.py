"""Page ids, catalogue fields, URLs and cache keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import names
from .let import let, lookup, spelt

# Pages that are named, and kinds of sheets without a map.
NAMED_PAGES = ("cbd1", "cbd2", "cbda", "cbdb")
NO_MAP = r"(?i)(?:^|_)p(covr|titl|ind\d*|note)$"
_PAGE = r"(?i)(?:^|_)p(\d+[a-z]?|" + "|".join(NAMED_PAGES) + ")$"
_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def page_from_slug(slug: Column) -> Column:
    """The page id at the end of a layer's slug; named pages in lower case, numbered ones as written; else null."""
    return let(_found(slug, _PAGE), lambda p: F.when(F.lower(p).isin(*NAMED_PAGES), F.lower(p)).otherwise(p))


def non_addressable_kind(slug: Column) -> Column:
    return F.lower(_found(slug, NO_MAP))


def slug_for_page(volume: Column, page: Column) -> Column:
    return F.concat(volume, F.lit("_p"), page)


def valid_review_page(page: Column) -> Column:
    return page.rlike(r"^\d+[A-Za-z]?$") | page.isin(*NAMED_PAGES)


def page_order(page: Column) -> list[Column]:
    """Natural order: numbers first, by value."""
    return [page.try_cast("int").asc_nulls_last(), page.asc()]


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)


def page_of_sheet_url(url: Column) -> Column:
    """The page id in a sheet file's name: four digits with an optional letter, without their zeros, or a word."""
    stem = F.regexp_replace(F.element_at(F.split(_path(url), "/"), -1), r"\.[^.]*$", "")
    tag = _found(stem, r"-(\d{4}[A-Za-z]?|[A-Za-z]+\d*)$")
    return F.when(tag.rlike(r"^\d{4}"), F.concat(F.substring(tag, 1, 4).cast("int").cast("string"), F.substring(tag, 5, 10))).otherwise(tag)


def service_id(url: Column, host: str, prefix: str, root: str) -> Column:
    """An image service's id: the path under a prefix, without suffix, slashes as colons; else null."""
    tail = F.regexp_replace(F.substring(_path(url), len(prefix) + 1, 1 << 20), r"\.[^./]*$", "")
    ok = (F.lower(F.regexp_extract(url, r"^[^:/?#]*://([^/?#:]*)", 1)) == host) & F.startswith(_path(url), F.lit(prefix))
    return F.when(ok, F.concat(F.lit(root), F.translate(tail, "/", ":")))


def item_slug(url: Column, kind: str = "item") -> Column:
    """The last part of a URL's path, where the part before it is `kind`; else the URL's path as it is."""
    return let(F.filter(F.split(_path(url), "/"), lambda x: x != ""), lambda p: F.when(F.try_element_at(p, F.lit(-2)) == kind, F.try_element_at(p, F.lit(-1))).otherwise(url))


def catalog_year(date: Column, desc: Column, created: Column, volume: Column) -> Column:
    """struct(year, source): a catalogue's date, unless its description says otherwise."""
    d = F.nullif(F.regexp_extract(date, r"^(\d{4})", 1), F.lit(""))
    said, month = _found(desc, r"^(\d{4})\."), _found(desc, rf"^(?:{_MONTHS})\s+(\d{{4}})\.")
    made = _found(created, r"\b(\d{4})\b")
    conflict = said.isNotNull() & volume.isNull() & d.isNotNull() & (said != d) & (said == made)
    told = F.coalesce(said, F.when(month == made, month))
    by_desc = d.isNull() & told.isNotNull()
    source = F.when(conflict, "description-conflict").when(by_desc, "description").otherwise("date")
    return F.struct(F.when(conflict, said).when(by_desc, told).otherwise(F.coalesce(d, date)).alias("year"), source.alias("source"))


def era_label(year: Column, buckets: list[tuple[str, int, int]]) -> Column:
    """The label of the first bucket that holds a year, else the year."""
    out = F.coalesce(*[F.when(year.between(lo, hi), F.lit(label)) for label, lo, hi in buckets], year.cast("string"))
    return F.when(year.isNotNull(), out)


def model_ref(ref: Column, default: str) -> Column:
    """struct(provider, model) of ``provider:model`` or a bare model."""
    has = F.contains(ref, F.lit(":"))
    return F.struct(F.when(has, F.substring_index(ref, ":", 1)).otherwise(default).alias("provider"), F.when(has, F.regexp_replace(ref, "^[^:]*:", "")).otherwise(ref).alias("model"))


def _json_string(x: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")


def cache_key(model: Column, variant: Column, prompt: Column | None = None) -> Column:
    """A reversible file name of a model, its variant and prompt; the bare model where it has neither."""
    text = lambda x: F.when(x.isNull(), F.lit("null")).otherwise(_json_string(x))
    parts = [_json_string(model), text(variant)] + ([text(prompt)] if prompt is not None else [])
    if prompt is None:
        body = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    else:
        body = F.concat(F.lit("["), F.concat_ws(",", *parts[:2]), F.when(prompt.isNotNull(), F.concat(F.lit(","), parts[2])).otherwise(""), F.lit("]"))
    coded = F.regexp_replace(F.translate(F.base64(F.encode(body, "UTF-8")), "+/\r\n", "-_"), "=+$", "")
    bare = variant.isNull() if prompt is None else variant.isNull() & prompt.isNull()
    return F.when(bare, model).otherwise(F.concat(F.lit("v2-"), coded))


def model_of_cache_key(key: Column) -> Column:
    """The model of a cache key; keys that don't decode are models themselves."""
    coded = F.translate(F.substring(key, 4, 1 << 20), "-_", "+/")
    full = F.rpad(coded, (F.ceil(F.length(coded) / 4) * 4).cast("int"), "=")
    parts = F.from_json(F.try_to_binary(full, F.lit("base64")).cast("string"), "array<string>")
    return F.when(F.startswith(key, F.lit("v2-")), F.coalesce(F.try_element_at(parts, F.lit(1)), key)).otherwise(key)


def clean_street(raw: Column) -> Column:
    """A printed header without signs and ``continued``, its first direction as a letter."""
    t = F.regexp_replace(F.regexp_replace(raw, "[^A-Za-z0-9' ]+", " "), r"(?i)\bcontinued\b", " ")
    letters = {w: w[0] for w in ("NORTH", "SOUTH", "EAST", "WEST")}
    return let(F.split(names.blanks(names.upper(t)), " "), lambda w: spelt(F.concat(F.array(lookup(letters, w[0])), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))))))


def label_fold(name: Column) -> Column:
    """Signs deleted, blanks single, upper case."""
    return names.blanks(F.regexp_replace(names.upper(name), "[^A-Z0-9 ]", ""))


def plain_year(text: Column) -> Column:
    return F.regexp_extract(text, r"\b(\d{4})\b", 1).try_cast("int")
