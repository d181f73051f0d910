"""Tolerant and strict readers of JSON records, GeoJSON features, listings and sidecars, and the JSON that is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions.names import clean, normalize, renames, split_typed_name, strip_prefixes
from ..operators.sequences import joined_lines


#: Schemas of what is read; a field that is missing is null.
RECORD = (
    "page string, status string, n_streets int, n_candidates int, n_inliers int, rotation_deg double, auto_residuals_m array<double>, "
    "inlier_streets array<array<string>>, gcps_geojson struct<features: array<struct<geometry: struct<coordinates: array<double>>, "
    "properties: struct<image: array<double>, username: string, note: string>>>>, seam_adjusted struct<dx_m: double, dy_m: double>"
)
FEATURES = "features array<struct<type: string, geometry: string, properties: map<string, string>>>"
#: Classes of ways that are never streets.
NO_STREETS = ("footway", "cycleway", "path", "service", "steps")


def tolerant_int(json: Column, path: str) -> Column:
    """A whole number at a JSON path, else null; nothing raises."""
    return F.get_json_object(json, path).try_cast("int")


def numerals_from_raw(raw: Column) -> Column:
    """array<struct(value, bbox, street)> of a reading's numerals; items without a number or a box of four are left out."""
    item = "array<struct<value: string, bbox: array<double>, street: string>>"
    items = F.coalesce(F.from_json(F.get_json_object(raw, "$.address_numerals"), item), F.array().cast(item))
    good = F.filter(items, lambda i: i.isNotNull() & i["value"].try_cast("int").isNotNull() & (F.size(i["bbox"]) == 4) & F.forall(i["bbox"], lambda v: v.isNotNull()))
    return F.transform(good, lambda i: F.struct(i["value"].try_cast("int").alias("value"), i["bbox"].alias("bbox"), i["street"].alias("street")))


def _unfenced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*|\s*```$", ""))


def json_from_prose(text: Column) -> Column:
    """The first JSON object in an answer, without fences or prose about it; null where there is none.

    If the whole answer is an object with a text under ``result``, the object is looked for in that text.
    """
    whole = _unfenced(text)
    alone = F.json_array_length(F.concat(F.lit("["), whole, F.lit("]"))) == 1
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(whole), "$.result", "variant"))
    body = F.when(alone & (kind == "STRING"), _unfenced(F.get_json_object(whole, "$.result"))).otherwise(whole)
    start = F.instr(body, "{")
    # a parser reads one value from the first brace on, whatever follows it
    return F.when(start > 0, F.get_json_object(F.substr(body, start), "$"))


def read_records(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """Records of a folder of JSON files, one object a file: the page from the record, else from the file's name.

    Strict reading fails on a damaged file; otherwise its row has `damaged` true.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    schema = RECORD if strict else RECORD + ", _damaged string"
    r = spark.read.schema(schema).option("multiLine", True).option("mode", mode).option("columnNameOfCorruptRecord", "_damaged").json(folder)
    r = r.withColumn("file", F.col("_metadata.file_name"))
    page = F.coalesce("page", F.nullif(F.regexp_extract("file", r"^p(.+)\.json$", 1), F.lit("")))
    damaged = F.lit(False) if strict else F.col("_damaged").isNotNull()
    return r.withColumn("page", page).withColumn("damaged", damaged).drop("_damaged")


def control_points(records: DataFrame) -> DataFrame:
    """(page, ord, px, py, lng, lat, synthetic) of records' control points."""
    g = records.select("page", F.posexplode("gcps_geojson.features").alias("ord", "f"))
    image, at = F.col("f.properties.image"), F.col("f.geometry.coordinates")
    synthetic = F.coalesce(F.contains(F.col("f.properties.note"), F.lit("synthetic")), F.lit(False))
    return g.select("page", "ord", image[0].alias("px"), image[1].alias("py"), at[0].alias("lng"), at[1].alias("lat"), synthetic.alias("synthetic"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(ord, properties, parts) of a GeoJSON collection of lines; a single line is one part."""
    whole = spark.read.schema(FEATURES).option("multiLine", True).json(path)
    f = whole.select(F.posexplode("features").alias("ord", "f"))
    point = "array<array<double>>"
    kind = F.get_json_object("f.geometry", "$.type")
    coords = F.get_json_object("f.geometry", "$.coordinates")
    parts = F.when(kind == "LineString", F.array(F.from_json(coords, point))).when(kind == "MultiLineString", F.from_json(coords, f"array<{point}>"))
    xy = F.transform(parts, lambda part: F.transform(part, lambda c: F.struct(c[0].alias("x"), c[1].alias("y"))))
    return f.select("ord", F.col("f.properties").alias("properties"), xy.alias("parts")).filter("parts is not null")


def usable_ways(elements: DataFrame) -> DataFrame:
    """Ways (type, id, tags, geometry) of two points at least that have a street's name: excluded kinds and areas go, ways
    without a kind stay, and a name has to be more than a type."""
    tags = F.col("tags")
    named = F.coalesce(tags["name"] != "", F.lit(False)) & (split_typed_name(F.coalesce(tags["name"], F.lit(""))).getField("name") != "")
    ok = (F.col("type") == "way") & (F.size("geometry") >= 2) & named
    gone = F.coalesce(tags["highway"].isin(*NO_STREETS), F.lit(False)) | F.coalesce(tags["area"] == "yes", F.lit(False))
    return elements.filter(ok & ~gone)


def checked_response(responses: DataFrame) -> DataFrame:
    """Responses, failing where a remark says that the server gave up."""
    bad = F.lower(F.coalesce("remark", F.lit(""))).rlike("error|timed out")
    return responses.withColumn("remark", F.when(F.assert_true(~bad, "the response is incomplete").isNull(), F.col("remark")))


def merged_ways(cached: DataFrame, fetched: DataFrame) -> DataFrame:
    """Cached ways with fetched ones in their places: whole ways, the newer response wins."""
    return cached.join(fetched.select("id").distinct(), "id", "left_anti").unionByName(fetched)


def covers(boxes: Column, need: Column) -> Column:
    """Whether one of the fetched boxes holds the box that is needed."""
    return F.exists(boxes, lambda b: (b[0] <= need[0]) & (b[1] <= need[1]) & (b[2] >= need[2]) & (b[3] >= need[3]))


def ground_truth(layers: DataFrame) -> DataFrame:
    """One row a page of layers (rank, ord, slug, ..): unknown slugs are left out, a file's last and the first source's win."""
    page = layers.withColumn("page", P.page_from_slug(F.col("slug"))).filter("page is not null")
    rest = [c for c in page.columns if c not in ("rank", "page")]
    last = page.groupBy("rank", "page").agg(F.max_by(F.struct(*rest), "ord").alias("r"))
    first = last.groupBy(F.lower("page").alias("fold")).agg(F.min(F.struct("rank", "page")).alias("k"), F.min_by("r", F.struct("rank", "page")).alias("r"))
    return first.select(F.col("k.rank").alias("rank"), F.col("k.page").alias("page"), *[F.col(f"r.{c}").alias(c) for c in rest])


def sheet_inputs(annotations: DataFrame, manifest: DataFrame) -> DataFrame:
    return annotations.join(manifest, "page")


def archives(listing: DataFrame) -> DataFrame:
    """(volume, path) of a listing (path, length): empty files and overviews are left out."""
    name = F.regexp_extract("path", r"([^/]+)\.pmtiles$", 1)
    return listing.withColumn("volume", name).filter((F.col("length") > 0) & (name != "") & ~F.endswith(name, F.lit("-overview"))).select("volume", "path")


def tallest_variants(files: DataFrame, mimetype: str) -> DataFrame:
    """(item, group, url) of each group's tallest file of a type, the first of equal ones. files: (item, group, pos, url, mimetype, height)."""
    f = files.filter(F.col("mimetype") == mimetype)
    best = f.groupBy("item", "group").agg(F.max_by("url", F.struct(F.coalesce("height", F.lit(0)), -F.col("pos"))).alias("url"))
    return best


def item_page(items: DataFrame, volume: str) -> DataFrame:
    """(volume, items, n): one JSON array a volume, in natural page order. items: (volume, page, ..)."""
    rest = [c for c in items.columns if c != volume]
    key = F.struct(F.coalesce(F.col("page").try_cast("int"), F.lit(2**31 - 1)).alias("k"), F.col("page").alias("p"), F.struct(*rest).alias("item"))
    out = items.groupBy(volume).agg(F.array_sort(F.collect_list(key)).alias("i"), F.count(F.lit(1)).alias("n"))
    return out.select(volume, F.to_json(F.transform("i", lambda x: x["item"])).alias("items"), "n")


def georeference(points: Column, image: Column, width: Column, height: Column) -> Column:
    """The JSON annotation of one sheet: its image, frame and control points (px, py, lng, lat)."""
    feature = lambda p: F.struct(
        F.lit("Feature").alias("type"), F.struct(F.array(p["px"], p["py"]).alias("resourceCoords")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(p["lng"], p["lat"]).alias("coordinates")).alias("geometry"),
    )
    body = F.struct(F.lit("FeatureCollection").alias("type"), F.struct(F.lit("polynomial").alias("type")).alias("transformation"), F.transform(points, feature).alias("features"))
    return F.to_json(F.struct(F.lit("Annotation").alias("type"), F.lit("georeferencing").alias("motivation"), F.struct(image.alias("id"), width.alias("width"), height.alias("height")).alias("target"), body.alias("body")))


def updated_sums(manifest: DataFrame, written: DataFrame) -> DataFrame:
    """(ord, path, sha256): lines whose file was written get its hash, the others stay in their places; new paths follow."""
    old = manifest.join(written.select("path", F.col("sha256").alias("new")), "path", "left")
    kept = old.select("ord", "path", F.coalesce("new", "sha256").alias("sha256"))
    more = written.join(manifest, "path", "left_anti").select(F.lit(None).cast("long").alias("ord"), "path", "sha256")
    return kept.unionByName(more)


def checked_sidecar(rows: DataFrame) -> DataFrame:
    """Counters of a sidecar; a value of the wrong kind is null."""
    n = lambda c: F.when(F.col(c).try_cast("int") >= 0, F.col(c).try_cast("int")).alias(c)
    return rows.select("volume", n("reads"), n("matched"))


def read_queue(rows: DataFrame) -> DataFrame:
    """Queue rows of JSON lines (value): unknown keys dropped, defaults filled, damaged rows marked."""
    schema = "volume string, track string, status string, added double, started double, finished double, exit_code int, note string, then_serve boolean"
    q = rows.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("q"))
    bad = F.col("q").isNull() | F.col("q.volume").isNull()
    return q.select(
        "q.volume", F.coalesce("q.track", F.lit("place")).alias("track"), F.coalesce("q.status", F.lit("queued")).alias("status"), "q.added", "q.started", "q.finished",
        "q.exit_code", F.coalesce("q.note", F.lit("")).alias("note"), F.coalesce("q.then_serve", F.lit(False)).alias("then_serve"), bad.alias("quarantined"),
    )


def write_if_changed(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Write df as Parquet unless the same rows are there, repeated ones as often; returns whether it wrote.

    Rows are compared by their number and by two sums of hashes, which neither order nor repeats cancel.
    """

    def mark(d: DataFrame) -> tuple:
        whole = F.to_json(F.struct(*sorted(d.columns)), {"ignoreNullFields": "false"})
        total = lambda h: F.sum(h.cast("decimal(38,0)"))
        return tuple(d.agg(F.count(F.lit(1)), total(F.xxhash64(whole)), total(F.xxhash64(F.lit(1), whole))).first())

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    if there and mark(spark.read.parquet(path)) == mark(df):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def archive_bounds(files: DataFrame) -> DataFrame:
    """(path, west, south, east, north) from the header of tile archives of version 3: four signed 32-bit numbers of 1e-7
    degrees from byte 102 on. files: (path, content)."""

    def number(at: int) -> Column:
        parts = [F.conv(F.hex(F.substring("content", at + 1 + i, 1)), 16, 10).cast("long") * (256**i) for i in range(4)]
        total = parts[0] + parts[1] + parts[2] + parts[3]
        return F.when(total >= 2**31, total - 2**32).otherwise(total) / 1e7

    ok = F.hex(F.substring("content", 1, 7)) == F.hex(F.lit("PMTiles"))
    return files.filter(ok).select("path", number(102).alias("west"), number(106).alias("south"), number(110).alias("east"), number(114).alias("north"))


def gazetteer(bindings: DataFrame) -> DataFrame:
    """(label, group_key) of a gazetteer's JSON bindings (value: label -> groups), both in canonical form."""
    from ..functions.names import normalize_rail_name

    m = F.from_json(F.get_json_object("value", "$.bindings"), "map<string, array<string>>")
    each = bindings.select(F.explode(m).alias("label", "groups")).select(normalize_rail_name(F.col("label")).alias("label"), F.explode("groups").alias("g"))
    return each.select("label", normalize_rail_name(F.col("g")).alias("group_key")).distinct()


def rename_pairs(lines: DataFrame, group: list[str], order: list[str], line: str) -> DataFrame:
    """(group, old, new, line) of the entries of printed lists, whose lines come in order and may run on."""
    entries = joined_lines(lines, group, order, line)
    return entries.select(*group, line, F.explode(renames(F.col(line))).alias("r")).select(*group, "r.old", "r.new", line)


#: A catalogue item as it comes; what is missing or of another kind is null.
CATALOG = "id string, title string, date string, digitized boolean, description array<string>, item struct<created_published: string>, resources array<struct<files: string, url: string>>"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Items of a catalogue's JSON dump, one array of them."""
    return spark.read.schema(CATALOG).option("multiLine", True).json(path)


def volume_records(items: DataFrame) -> DataFrame:
    """(item_id, title, date, digitized, sheet_count, urls) of catalogue items; the first whole number of files counts."""
    files = F.filter(F.transform("resources", lambda r: F.when(r["files"].rlike(r"^\d{1,9}$"), r["files"]).try_cast("int")), lambda n: n.isNotNull())
    none = F.array().cast("array<string>")
    urls = F.coalesce(F.filter(F.transform("resources", lambda r: r["url"]), lambda u: u.isNotNull()), none)
    return items.select(
        P.item_slug(F.coalesce("id", F.lit(""))).alias("item_id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("date", F.lit("")).alias("date"),
        F.coalesce("digitized", F.lit(False)).alias("digitized"), F.try_element_at(files, F.lit(1)).alias("sheet_count"), urls.alias("urls"),
    )


def catalog_titles(items: DataFrame, city: str, boilerplate: list[str]) -> DataFrame:
    """(item_id, title, year, year_source, volume_number, subject) of the items that have an id and a year."""
    said = F.coalesce(F.try_element_at("description", F.lit(1)), F.lit(""))
    number = F.nullif(F.regexp_replace(F.regexp_extract(said, r"^Vol\. ([\w.]+)", 1), "[.,]+$", ""), F.lit(""))
    year = P.catalog_year(F.coalesce("date", F.lit("")), said, F.coalesce("item.created_published", F.lit("")), number)
    ident = F.regexp_extract(F.coalesce("id", F.lit("")), r"([^/]*)/*$", 1)
    t = items.select(ident.alias("item_id"), year.alias("y"), number.alias("volume_number"), F.when(number.isNull(), strip_prefixes(said, boilerplate)).alias("subject"))
    t = t.withColumn("subject", F.nullif("subject", F.lit(""))).filter((F.col("item_id") != "") & F.col("y.year").rlike(r"^\d{4}"))
    title = F.concat_ws(" | ", F.lit(city), F.left(F.col("y.year"), F.lit(4)), F.coalesce("subject", F.concat(F.lit("Vol. "), F.coalesce("volume_number", F.lit("?")))))
    return t.select("item_id", title.alias("title"), F.left(F.col("y.year"), F.lit(4)).cast("int").alias("year"), F.col("y.source").alias("year_source"), "volume_number", "subject")


def sheet_reads(pages: DataFrame) -> DataFrame:
    """(page, keys, raws, numerals) of annotations (page, streets array<string>, numerals array<struct(street, value)>): street
    keys and cleaned names as sets, and the numbers of each cleaned street in the order in which they stand."""
    named = F.filter("streets", lambda s: s.isNotNull() & (s != ""))
    some = F.filter("numerals", lambda n: n["street"].isNotNull() & (n["street"] != "") & n["value"].isNotNull())
    clean_ = F.transform(some, lambda n: F.struct(clean(n["street"]).alias("street"), n["value"].alias("value")))
    p = pages.select("page", F.array_sort(F.array_distinct(F.filter(F.transform(named, lambda s: normalize(s)), lambda k: k != ""))).alias("keys"), F.array_sort(F.array_distinct(F.transform(named, clean))).alias("raws"), clean_.alias("n_"))
    streets = F.array_sort(F.array_distinct(F.transform("n_", lambda n: n["street"])))
    by = F.map_from_entries(F.transform(streets, lambda s: F.struct(s, F.transform(F.filter("n_", lambda n: n["street"] == s), lambda n: n["value"]))))
    return p.select("page", "keys", "raws", by.alias("numerals"))
