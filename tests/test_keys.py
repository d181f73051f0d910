import pytest
from pyspark.sql import functions as F

from plumbline.functions import geometry as G
from plumbline.functions import names as N
from plumbline.functions import pages as P


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "key"),
    [
        ("W. Quarry Boul.", "QUARRY"), ("14TH CT.", "14TH CT"), ("W 14th Place", "14TH PL"), ("HERON AV S E", "HERON"), ("SOUTH WEST", "WEST"),
        ("AVENUE E", "AVENUE E"), ("TERRACE DRIVE", "TERRACE"), ("SOUTH STREET", "SOUTH"), ("W. 73 RD ST.", "73RD"), ("12 ST", "12"), ("BL'VD", "BLVD"), ("", ""), ("N", "N"),
    ],
)
def test_normalize(spark, raw, key):
    assert one(spark, N.normalize(F.lit(raw))) == key
    assert one(spark, N.normalize(N.normalize(F.lit(raw)))) == one(spark, N.normalize(F.lit(key)))


def test_aliases_are_looked_up_at_three_points(spark):
    a = F.create_map(F.lit("MACALISTER PL"), F.lit("LEXINGTON"), F.lit("STATE"), F.lit("MAIN"), F.lit("W OAK"), F.lit("ELM"))
    got = [one(spark, N.normalize(F.lit(x), a)) for x in ("Macalister Pl", "N State St", "State Ct", "W. Oak Ave")]
    assert got == ["LEXINGTON", "MAIN", "STATE", "ELM"]
    assert one(spark, N.centerline_key(F.lit("W 37TH"), F.lit("pl"))) == "37TH PL"
    assert one(spark, N.centerline_key(F.lit(None).cast("string"), F.lit("PL"))) is None


def test_fuzzy(spark):
    pairs = [("abcd", "abcd", True), ("abcd", "abce", True), ("abcd", "abc", True), ("abcd", "ab", False), ("", "a", True)]
    for x, y, want in pairs:
        assert one(spark, N.edit_distance_one(F.lit(x), F.lit(y))) is want
    t = lambda *w: F.array(*[F.lit(x) for x in w])
    assert one(spark, N.tokens_match(t("ELDREDGE", "ST"), t("ELDRIDGE", "ST"))) is True
    assert one(spark, N.tokens_match(t("OAK"), t("OAR"))) is False
    assert one(spark, N.tokens_match(t("A"), t("A", "B"))) is False


def test_pages(spark):
    got = [one(spark, P.page_from_slug(F.lit(s))) for s in ("x_p12", "p7a", "v_pCBD1", "map3", "v_p10_1", "v_p7A")]
    assert got == ["12", "7a", "cbd1", None, None, "7A"]
    assert one(spark, P.page_of_sheet_url(F.lit("https://h/a/v-0023.jp2"))) == "23"
    assert one(spark, P.page_of_sheet_url(F.lit("https://h/a/v-0005S.jp2"))) == "5S"
    key = P.cache_key(F.lit('m "x"'), F.lit("é"))
    assert one(spark, P.model_of_cache_key(key)) == 'm "x"'
    assert one(spark, P.model_of_cache_key(F.lit("v2-%%%"))) == "v2-%%%"
    assert one(spark, P.cache_key(F.lit("m"), F.lit(None).cast("string"))) == "m"


def test_models(spark):
    m = G.model(*[F.lit(v) for v in (10.0, 0.5, 0.1, 20.0, 0.2, -0.4)])
    back = G.invert_affine(m)
    p = G.apply_affine(back, G.apply_affine(m, F.lit(3.0), F.lit(7.0))["x"], G.apply_affine(m, F.lit(3.0), F.lit(7.0))["y"])
    x = one(spark, p)
    assert (round(x.x, 9), round(x.y, 9)) == (3.0, 7.0)
    assert one(spark, G.invert_affine(G.model(*[F.lit(v) for v in (0.0, 1.0, 2.0, 0.0, 2.0, 4.0)]))["a1"]) is None
    assert one(spark, G.grid_rmse_m(m, m, F.lit(100.0), F.lit(50.0))) == 0.0
    other = G.model(*[F.lit(v) for v in (13.0, 0.5, 0.1, 24.0, 0.2, -0.4)])
    assert abs(one(spark, G.grid_rmse_m(m, other, F.lit(100.0), F.lit(50.0), lat=F.lit(60.0))) - 2.5) < 1e-9


def test_angles_and_boxes(spark):
    assert [one(spark, G.fold_quadrant_deg(F.lit(a))) for a in (45.0, -45.0, 90.0, 179.0)] == [-45.0, -45.0, 0.0, -1.0]
    box = F.array(*[F.lit(v) for v in (1, 2, 3, 5)])
    turned = G.rotate_box(G.rotate_box(box, F.lit(90), F.lit(10), F.lit(20)), F.lit(270), F.lit(20), F.lit(10))
    assert one(spark, turned) == [1, 2, 3, 5]
    assert one(spark, G.parse_house_number(F.lit(" 12.9 "))) == 12
    assert [one(spark, G.parse_house_number(F.lit(x))) for x in ("inf", "-3", "0.5", "", "x")] == [None] * 5
    assert one(spark, G.usable_direction(F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert one(spark, G.usable_direction(F.array(F.lit(3.0), F.lit(4.0)))) == [0.6, 0.8]


def test_crossings(spark):
    d = lambda *v: [F.lit(float(x)) for x in v]
    x = one(spark, G.segment_crossing(*d(0, 0, 2, 2), *d(0, 2, 2, 0)))
    assert (x.x, x.y) == (1.0, 1.0)
    assert one(spark, G.segment_crossing(*d(0, 0, 1, 0), *d(0, 1, 1, 1))) is None
    assert one(spark, G.collinear_overlap(*d(0, 0, 2, 0), *d(1, 0, 3, 0))) is True
    assert one(spark, G.collinear_overlap(*d(0, 0, 1, 0), *d(1, 0, 3, 0))) is False
